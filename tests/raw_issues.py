"""Raw issue documents for the tests."""


def video(aid, mid=None, tid=1, view=1000, **other):
    """One raw video; any key can be overridden or, with None as a nested value, left empty."""
    base = {
        "aid": aid, "bvid": f"BV{aid}", "title": f"video {aid}", "desc": "d", "duration": 120, "pubdate": 1600000000,
        "cid": aid * 10, "pic": "p", "tid": tid, "tname": f"cat{tid}",
        "owner": {"mid": mid or aid + 1000, "name": f"up{mid or aid + 1000}", "face": "f"},
        "stat": {"aid": aid, "view": view, "like": 100, "coin": 20, "favorite": 30, "share": 5, "reply": 6, "danmaku": 7},
    }
    return {**base, **other}


def issue(number, videos, **config):
    header = {"subject": f"s{number}", "name": f"n{number}", "stime": 1600000000 + 604800 * (number - 1)}
    header["etime"] = header["stime"] + 604799
    return {"number": number, "config": {**header, **config}, "videos": videos}
