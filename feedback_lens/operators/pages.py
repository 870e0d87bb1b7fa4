"""Extraction of keys, attributes and reviews from stored pages.

Elements and patterns are data: every function takes them as arguments, and ``plans.corpus`` holds one profile per shop. Values and blocks are
read by a stack of tags (``functions.markup``), one page at a time; keys, page numbers and loose attributes by patterns in the JVM.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedback_lens.functions.markup import Page, Path
from feedback_lens.functions.normalize import strip_tags
from feedback_lens.session import bounded_batches

PAGES_AT_ONCE = 16


def extract_keys(pages: DataFrame, pattern: str, group: int = 1) -> DataFrame:
    """Every product key on every search page, with its place on the page."""
    found = F.regexp_extract_all("html", F.lit(pattern), F.lit(group))
    return pages.select("page_id", F.posexplode(found).alias("pos", "key")).filter(F.col("key") != "")


def url_tail(url: Column, parts: int) -> Column:
    """Last path parts of a link, without query, fragment, trailing slash or file suffix."""
    path = F.regexp_replace(F.regexp_replace(F.regexp_replace(url, r"[?#].*$", ""), "/$", ""), r"\.[a-z]+$", "")
    pieces = F.split(F.regexp_replace(path, "^[a-z]+://[^/]*/?", ""), "/")
    return F.array_join(F.slice(pieces, F.greatest(F.size(pieces) - (parts - 1), F.lit(1)), parts), "/")


def dedupe_keys(keys: DataFrame) -> DataFrame:
    """First occurrence of each key in page order."""
    place = F.struct("page_id", "pos")
    return keys.groupBy("key").agg(F.min(place).alias("place")).select("key", "place.page_id", "place.pos")


def drop_dead(keys: DataFrame, product_pages: DataFrame, marker: str) -> DataFrame:
    """Keys whose product page does not carry the "not found" marker."""
    dead = product_pages.filter(F.contains("html", F.lit(marker))).select("key")
    return keys.join(dead, "key", "left_anti")


def last_page(pages: DataFrame, pattern: str) -> DataFrame:
    """Highest page number shown in a product's pagination; 1 without pagination."""
    numbers = F.transform(F.regexp_extract_all("html", F.lit(pattern), F.lit(1)), lambda n: n.try_cast("int"))
    per_page = pages.select("key", F.array_max(numbers).alias("n"))
    return per_page.groupBy("key").agg(F.coalesce(F.max("n"), F.lit(1)).alias("last_page"))


def extract_attrs(pages: DataFrame, profile: Mapping[str, str], keep: Sequence[str] = ("page_id",)) -> DataFrame:
    """One column per named pattern, tags stripped; null where the page has no match."""
    attrs = [
        F.nullif(F.trim(strip_tags(F.regexp_extract("html", pattern, 1))), F.lit("")).alias(name)
        for name, pattern in profile.items()
    ]
    return pages.select(*keep, *attrs)


def attach_brand(reviews: DataFrame, product_pages: DataFrame, brand: Path) -> DataFrame:
    """Brand taken from the separate product page of each key."""
    found = read_values(product_pages, {"brand": brand}, keep=["key"])
    brands = found.groupBy("key").agg(F.min("brand").alias("brand"))
    return reviews.drop("brand").join(brands, "key", "left")


PageRows = Callable[[Page], list[list[str | None]]]


def _read_pages(
    pages: DataFrame, keep: Sequence[str], names: Sequence[str], rows_of: PageRows, numbered: bool, wanted: Sequence[Path]
) -> DataFrame:
    """Rows that each page gives, beside what is kept of it; a page without markup gives none. ``rows_of`` asks for the ``wanted`` paths only."""
    bounded_batches(pages.sparkSession)
    fields = [pages.schema[name] for name in keep]
    fields += [T.StructField("pos", T.IntegerType())] if numbered else []
    schema = T.StructType(fields + [T.StructField(name, T.StringType()) for name in names])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, PAGES_AT_ONCE):
                part = batch.slice(low, PAGES_AT_ONCE)
                places, numbers, rows = [], [], []
                for place, source in enumerate(part.column("html").to_pylist()):
                    found = [] if source is None else rows_of(Page(source, wanted))
                    places += [place] * len(found)
                    numbers += range(len(found))
                    rows += found
                kept = part.select(list(keep)).take(pa.array(places, pa.int64()))
                columns = [*kept.columns, *([pa.array(numbers, pa.int32())] if numbered else [])]
                columns += [pa.array([row[i] for row in rows], pa.string()) for i in range(len(names))]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return pages.select(*keep, "html").mapInArrow(read, schema)


def read_values(pages: DataFrame, values: Mapping[str, Path], keep: Sequence[str] = ("page_id",)) -> DataFrame:
    """One row per page: the first element of each path, trimmed; null where the page has none or it is empty."""
    read = _read_pages(pages, keep, list(values), lambda page: [[page.first(wanted) for wanted in values.values()]], False, list(values.values()))
    return read.withColumns({name: F.nullif(F.trim(name), F.lit("")) for name in values})


def read_blocks(
    pages: DataFrame,
    block: Path,
    fields: Mapping[str, Path],
    keep: Sequence[str] = ("page_id",),
    values: Mapping[str, Path] | None = None,
) -> DataFrame:
    """One row per review block: the first element of each field inside the block, null where it has none.

    A block ends where its element does, however its content is nested; what follows on the page belongs to no block. ``values`` are read
    once per page.
    """
    values = values or {}

    def rows_of(page: Page) -> list[list[str | None]]:
        of_page = [page.first(wanted) for wanted in values.values()]
        out = []
        for found in page.matches(block):
            inside = page.inside(found)
            out.append(of_page + [page.first(wanted, inside) for wanted in fields.values()])
        return out

    return _read_pages(pages, keep, [*values, *fields], rows_of, True, [*values.values(), block, *fields.values()])


def read_lists(
    pages: DataFrame,
    fields: Mapping[str, Path],
    driver: str,
    keep: Sequence[str] = ("page_id",),
    values: Mapping[str, Path] | None = None,
) -> DataFrame:
    """Separate lists of a page matched by position; as many rows as the driver list has, incomplete rows dropped."""
    values = values or {}

    def rows_of(page: Page) -> list[list[str | None]]:
        of_page = [page.first(wanted) for wanted in values.values()]
        lists = {name: [page.value(found, wanted) for found in page.matches(wanted)] for name, wanted in fields.items()}
        count = len(lists[driver])
        return [of_page + [found[i] if i < len(found) else None for found in lists.values()] for i in range(count)]

    return _read_pages(pages, keep, [*values, *fields], rows_of, True, [*values.values(), *fields.values()]).dropna(subset=list(fields))


def valid_rows(df: DataFrame, required: Sequence[str], rejects: Observation | None = None) -> DataFrame:
    """Rows whose required fields all parsed; the others are counted in ``rejects`` during the same pass."""
    good = F.lit(True)
    for name in required:
        good = good & F.col(name).isNotNull()
    if rejects is not None:
        df = df.observe(rejects, F.count_if(~good).alias("rejected"), F.count(F.lit(1)).alias("seen"))
    return df.filter(good)
