"""Source-level guards for rules every query must keep (checked on the package text)."""

import pathlib
import re

import pytest

PKG = pathlib.Path(__file__).resolve().parent.parent / "clicklens"


def sources():
    """Modules of the library; the training-data operators have rules and tests of their own."""
    names = {p.relative_to(PKG).as_posix(): p for p in PKG.rglob("*.py")}
    return {n: p.read_text() for n, p in names.items() if not n.startswith("llm/")}


def test_no_local_checkpoint_sampling_or_rdd():
    for name, text in sources().items():
        assert "localCheckpoint" not in text, name
        assert ".sample(" not in text and "sampleBy(" not in text, name
        assert ".rdd" not in text and "mapPartitions(" not in text, name
        assert "@F.udf" not in text and "F.udf(" not in text and "@udf" not in text, name


def test_limit_only_in_top_k():
    users = [n for n, t in sources().items() if re.search(r"\.limit\(", t)]
    assert users == ["operators/topk.py"]


def test_machine_local_temp_folder_only_as_unset_fallback():
    users = [n for n, t in sources().items() if "tempfile" in t]
    assert users == ["config.py"]
    text = sources()["config.py"]
    assert 'spark.conf.get("spark.checkpoint.dir"' in text


def test_no_temporary_folder_on_a_cluster():
    from types import SimpleNamespace
    from clicklens.config import shared_dir
    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda *a: None), sparkContext=context)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(session, "x")


def test_nothing_else_imports_the_training_data_operators():
    assert not [n for n, t in sources().items() if "clicklens.llm" in t or "corpus_pipeline" in t]
