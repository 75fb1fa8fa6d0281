import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def make_docs(spark):
    """Documents from (doc_id, text, lang, source) rows; extra columns clash with names the operators use."""
    def make(rows, extra=False):
        full = [(i, t, lang, src, None if t is None else len(t)) for i, t, lang, src in rows]
        if not extra:
            return spark.createDataFrame(full, COLUMNS)
        names = ["id", "score", "tokens", "label", "part", "kept", "domain", "pii", "fold", "group"]
        return spark.createDataFrame([(*r, *["x"] * len(names)) for r in full],
                                     COLUMNS + "".join(f", {n} string" for n in names))
    return make


@pytest.fixture()
def odd_docs(make_docs):
    """Nulls in every column, empty and blank texts, ties, repeated rows, a long text."""
    long_text = " ".join(f"word{i % 977} x{i}" for i in range(40_000))
    return make_docs([
        (0, "Alpha beta gamma delta epsilon zeta eta theta iota kappa", "en", "src0"),
        (1, None, "en", "src1"), (2, "", None, "src1"), (3, " \t\n ", "de", None), (4, "one", "en", "src0"),
        (5, "same text here again and again", "en", "src0"), (5, "same text here again and again", "en", "src0"),
        (6, "same text here again and again", None, None), (None, "no id on this one at all", "fr", "src2"),
        (None, None, None, None), (7, long_text, "en", "src0"), (8, "\U0001f600 naïve café \U0001f600 x", "es", "src3"),
    ], extra=True)


@pytest.fixture()
def no_docs(make_docs):
    return make_docs([])
