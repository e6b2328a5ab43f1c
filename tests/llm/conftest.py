import pytest

from sondeo.llm import common


@pytest.fixture
def docs(spark):
    """Makes a documents table with extra columns whose names the operators use inside."""

    def make(rows):
        return spark.createDataFrame([(i, t, "x", 1, 2, True, [0.5]) for i, t in rows], "doc_id long, text string, source string, keep_id int, _salt int, kept boolean, _stats array<double>").repartition(3)

    assert common.shared_dir(spark)
    return make


PHRASES = [f"word{i} alpha{i % 7} beta{i % 11} gamma{i % 13}" for i in range(400)]


def prose(start, words):
    """words words of text that no other start shares."""
    return " ".join(f"w{start}x{k * 7919 % 10007}" for k in range(words))
