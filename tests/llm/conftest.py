import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table from (doc_id, text) or (doc_id, text, source) rows."""

    def make(rows):
        rows = [(*r, "src0")[:3] if len(r) < 3 else r for r in rows]
        full = [(i, t, "en", s, None if t is None else len(t)) for i, t, s in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and long texts, ties and repeated rows."""
    long = " ".join(f"w{i % 997}x{i}" for i in range(20_000))
    return [(1, "alpha beta gamma delta epsilon zeta"), (1, "alpha beta gamma delta epsilon zeta"), (2, None), (3, ""), (None, "no id here at all, none"), (4, " \n\t \n"), (5, long), (6, "alpha beta gamma delta epsilon zeta", None), (7, "ß é　x 😀 ok", "src1")]


@pytest.fixture(scope="session")
def clashing(spark):
    """Gives a table extra columns whose names the operators use inside."""
    from pyspark.sql import functions as F

    return lambda df: df.withColumns({c: F.lit(7) for c in ("x", "y", "node", "key", "root", "rank", "shard", "slot", "size", "_h", "_part", "pos", "ids", "kept", "failed", "_c0", "copies", "n_words", "score", "hilbert")})
