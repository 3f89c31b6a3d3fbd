"""Fixtures of the tests in this folder; a second conftest would hide the one above."""

import pytest

#: Columns that operators use for their own results or inside their plans; inputs that carry them must not break anything.
CLASH = ["score", "fp", "row", "component_id", "spans", "text_", "label", "_text", "_h", "u", "v", "n", "k", "rejected", "pieces", "kind", "doc", "seq",
         "rank", "dim", "x", "mix_factor"]


@pytest.fixture
def make_docs(spark):
    """Documents from (doc_id, text, lang, source) rows, with extra columns of clashing names."""
    def make(rows, clash=True):
        extra = CLASH if clash else []
        schema = "doc_id long, text string, lang string, source string, n_chars long" + "".join(f", `{c}` string" for c in extra)
        return spark.createDataFrame([(i, t, la, s, None if t is None else len(t), *["?"] * len(extra)) for i, t, la, s in rows], schema)
    return make


@pytest.fixture
def make_table(spark, tmp_path):
    """Writes frames as the tables of a data folder and returns the folder."""
    def make(**tables):
        for name, df in tables.items():
            df.write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)
    return make
