"""Session helpers (spread, empty frames) and the one-fold key rule."""
import hashlib
import re
import unicodedata

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarry.functions.keys import canonical_key
from quarry.functions.text import fold_text, folded
from quarry.sources.inline import empty_frame, one_row


def test_intermediate_tables_need_a_named_folder():
    from types import SimpleNamespace as Of

    from quarry import session
    unset = Of(conf=Of(get=lambda key, default: default), sparkContext=Of(getCheckpointDir=lambda: None))
    with pytest.raises(RuntimeError):
        session.checkpoint_root(unset)


def test_jvm_fold_equals_the_rule(spark):
    import unicodedata
    chars = [chr(c) for c in (*range(0x20, 0x250), *range(0x1E00, 0x1F00), *range(0x2000, 0x2200), *range(0xFB00, 0xFB07), *range(0xFF01, 0xFF5F), 0x301, 0x130, 0x3C2)]
    texts = [*chars, "Épuisé", "ÉTÉ e\u0301t\u0301", "Straße ﬁn Ⅻ", "", None]
    rule = lambda t: None if t is None else "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c)).casefold()
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    for fold in (folded, fold_text):
        assert [r.f for r in df.orderBy("i").select(fold("t").alias("f")).collect()] == [rule(t) for t in texts]
    plan = df.select(folded("t"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def test_empty_and_one_row_frames_are_jvm_side(spark):
    e = empty_frame(spark, "a bigint, b string, c timestamp")
    assert e.count() == 0 and [f.name for f in e.schema.fields] == ["a", "b", "c"]
    assert str(e.schema["c"].dataType) == "TimestampType()"
    plan = e._jdf.queryExecution().executedPlan().toString()
    assert "ExistingRDD" not in plan and "PythonRDD" not in plan
    r = one_row(spark, {"a": 3, "b": None}, "a bigint, b string").collect()
    assert [tuple(x) for x in r] == [(3, None)]


def _py_key(*parts):
    """The stored-key rule in plain Python: storage text or '', NFKD folded
    to lower-case ASCII per part, joined with '|', SHA-256."""
    def storage(v):
        if v is None:
            return None
        t = re.sub(r"\s+", " ", str(v)).strip()
        return t or None

    def fold(v):
        return unicodedata.normalize("NFKD", v).encode("ascii", "ignore").decode().lower()
    return hashlib.sha256("|".join(fold(storage(p) or "") for p in parts).encode()).hexdigest()


def test_key_folds_joined_text_like_parts(spark):
    rows = [("Café", "Crèmé", None), ("́x", "ȩ́", "  "), ("ﬁn  ÉTÉ", "", "Ⅻ"),
            ("a|b", " Ñ ", "日本"), ("", None, "Straße")]
    df = spark.createDataFrame(rows, "a string, b string, c string")
    got = [r.k for r in df.select(canonical_key(F.lit("book"), F.col("a"), F.col("b"), F.col("c"))
                                  .alias("k")).collect()]
    assert got == [_py_key("book", *r) for r in rows]


# Latin letters, accents (precomposed and combining), ligatures, the key
# separator and whitespace; U+001C-U+001F are left out (whitespace for Python,
# not for Java, see README "Known differences").
_ALPHABET = st.sampled_from(list("abcXYZ09 |-'\t\n") + [chr(c) for c in range(0xC0, 0x180)]
                            + [chr(c) for c in range(0x300, 0x316)] + ["ﬁ", "ﬀ", "Ⅻ", " ", " "])
_PART = st.one_of(st.none(), st.text(_ALPHABET, max_size=12))


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(_PART, _PART, _PART), min_size=1, max_size=80))
def test_key_property_matches_python_rule(spark, rows):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, a string, b string, c string")
    got = [r.k for r in df.orderBy("i").select(
        canonical_key(F.lit("car"), F.col("a"), F.col("b"), F.col("c")).alias("k")).collect()]
    assert got == [_py_key("car", *r) for r in rows]
