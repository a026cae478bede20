"""Extraction hands rows on in small packs, however many pages come in one batch."""
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quarry.operators import extract as X
from quarry.operators import html as H

SPEC = X.Spec(records=("li",), fields=(X.Field("t", ("a",)), X.Field("info", ("tr",), X.MAP)),
              page_fields=(X.Field("n_links", ("a",), X.COUNT),))
SCHEMA = "page_id long, url string, html string"


def _pages(n: int, more: str = "") -> list[tuple]:
    return [(i, f"http://s/{i}", f"<ul><li><a>x{i}</a><li><a>y{i}</a></ul>{more}" if i % 7 else None) for i in range(n)]


def _sent(spark, monkeypatch, extractor, pages: list[tuple]):
    """(pages parsed before each pack, packs): the worker's function over all pages as one batch."""
    df, got = spark.createDataFrame(pages[:1], SCHEMA), []
    monkeypatch.setattr(type(df), "mapInArrow", lambda self, f, schema: got.append(f))
    extractor(df, SPEC, ("page_id",))
    monkeypatch.undo()
    parsed, packs, parse = [0], [], H.parse

    def counted(html):
        parsed[-1] += 1
        return parse(html)

    monkeypatch.setattr(H, "parse", counted)
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*[(p[0], p[1], p[2]) for p in pages])], ["page_id", "url", "html"])
    for pack in got[0](iter([batch])):
        packs.append(pack)
        parsed.append(0)
    return parsed, packs


@pytest.mark.parametrize("extractor", [X.extract, X.extract_nested])
def test_packs_are_small_and_whole(spark, monkeypatch, extractor):
    pages = _pages(5000)
    parsed, packs = _sent(spark, monkeypatch, extractor, pages)
    assert max(parsed) <= X.PACK_ROWS and max(p.num_rows for p in packs) <= X.PACK_ROWS
    ids = [i for p in packs for i in p.column("page_id").to_pylist()]
    assert ids == ([i for i, _, h in pages for _ in range(2 if h else 0)] if extractor is X.extract else list(range(5000)))


@pytest.mark.parametrize("extractor", [X.extract, X.extract_nested])
def test_long_pages_make_short_packs(spark, monkeypatch, extractor):
    parsed, packs = _sent(spark, monkeypatch, extractor, _pages(50, "<p>" + "z" * (X.PACK_CHARS // 4)))
    assert max(parsed) <= 5 and sum(p.num_rows for p in packs) == (84 if extractor is X.extract else 50)


def test_rows_of_many_batches_agree(spark):
    pages = [*_pages(3000), (None, None, "<li><a href='z'>n</a><table><tr><th>A</th><td>b</td></tr></table>"), ((1 << 53) + 1, None, "")]
    df = spark.createDataFrame(pages, SCHEMA).coalesce(1)
    flat = X.extract(df, SPEC, ("page_id", "url"))
    nested = X.extract_nested(df, SPEC, ("page_id", "url"))
    again = nested.select("page_id", "url", "ready", F.explode("records").alias("r"), "n_records", "n_links") \
                  .select("page_id", "url", "ready", "r.position", "n_records", "n_links", "r.t", "r.info")
    assert nested.count() == len(pages)
    rows = sorted(map(str, flat.collect()))
    assert rows == sorted(map(str, again.collect())) and len(rows) == 2 * sum(p[2] is not None for p in pages[:3000]) + 1
    one = flat.where("page_id IS NULL").first()
    assert (one.t, one.info, one.position, one.n_records, one.n_links) == ("n", {"a": "b"}, 1, 1, 1)
    assert nested.where(F.col("page_id") == (1 << 53) + 1).first().records == []
