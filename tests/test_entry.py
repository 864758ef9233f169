import builtins
import importlib

import pytest

import __spark_entry__


def test_entry_works_without_the_subpackage(monkeypatch):
    """The training-data subpackage and the pipeline may be taken out."""
    real = builtins.__import__

    def missing(name, *args, **kwargs):
        if name.startswith(("issuelens.llm", "corpus_pipeline")):
            raise ModuleNotFoundError(f"No module named '{name}'", name=name)
        return real(name, *args, **kwargs)

    monkeypatch.setattr(builtins, "__import__", missing)
    bare = importlib.reload(__spark_entry__)
    assert "stats_overall" in bare.queries() and not any(k.startswith("op") or k == "pipeline" for k in bare.queries())
    monkeypatch.undo()
    importlib.reload(__spark_entry__)


def test_other_missing_modules_are_not_swallowed(monkeypatch):
    real = builtins.__import__

    def missing(name, *args, **kwargs):
        if name == "corpus_pipeline":
            raise ModuleNotFoundError("No module named 'numpy'", name="numpy")
        return real(name, *args, **kwargs)

    monkeypatch.setattr(builtins, "__import__", missing)
    with pytest.raises(ModuleNotFoundError):
        importlib.reload(__spark_entry__)
    monkeypatch.undo()
    importlib.reload(__spark_entry__)
