"""Landed API responses -> rows (A1-A3) and their completeness audit.

A landed page is one response: (service, rent_dt, start_index, end_index, body).
The collecting client asks for pages 1..1000, 1001..2000, ... and stops at the
first page that fails, or after the last page. Pages landed beyond a stop are
never read. The stop rule is computed per (service, rent_dt) from small page
metadata with aggregates and one anti join on the page number, so a day with
millions of pages never lands in one task; only then are the valid bodies
exploded into rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rental_mart.schemas import PAGE_SIZE

GROUP = ("service", "rent_dt")
PAGE = ("service", "rent_dt", "start_index", "end_index", "body")
# Pages dealt to a task together when bodies are shuffled: a day of many pages is many keys.
PAGES_TOGETHER = 64
RESULT_KEY = "RESULT"  # fixed value: root key of an error / end-of-data response


def envelope_schema(row_schema: T.StructType) -> T.DataType:
    """{<root key>: {list_total_count, row: [...]}}; the count is read as text so
    both 15 and "15" parse."""
    return T.MapType(T.StringType(), T.StructType([
        T.StructField("list_total_count", T.StringType()),
        T.StructField("row", T.ArrayType(row_schema)),
    ]))


# Page flags only need to know whether each row is an object: an empty struct
# makes the parser skip every field, so the flag pass never converts row values.
_ROW_PRESENCE = T.StructType([])


def _as_text(row_schema: T.StructType) -> T.StructType:
    """Row fields read as JSON text: any scalar, object or array is kept as its
    raw text, so one odd value never voids the whole page (as a typed parse
    would); values are cast to the declared types afterwards."""
    return T.StructType([T.StructField(f.name, T.StringType()) for f in row_schema.fields])


def _first_root_value(body: Column, first: Column, row_schema: T.StructType) -> Column:
    """The envelope under the first root key, or NULL when that value is not an
    object. One parse of the whole body serves the usual single-key response; a
    body where another root value does not fit the envelope (which nulls the
    whole map) falls back to parsing the first value's own text."""
    env = envelope_schema(row_schema)
    whole = F.try_element_at(F.from_json(body, env), first)
    first_text = F.try_element_at(F.from_json(body, T.MapType(T.StringType(), T.StringType())), first)
    fallback = F.when(F.ltrim(first_text).startswith("{"), F.from_json(first_text, env.valueType))
    return F.when(whole.isNotNull(), whole).otherwise(fallback)


def _page_no(page_size: int) -> Column:
    """1, 2, ... for the start indexes the client requests; NULL for any other."""
    aligned = (F.col("start_index") >= 1) & ((F.col("start_index") - 1) % page_size == 0)
    return F.when(aligned, (F.col("start_index") - 1) / page_size + 1).cast("long")


def _parsed(pages: DataFrame, row_schema: T.StructType, page_size: int) -> DataFrame:
    body = F.col("body")
    keys = F.json_object_keys(body)
    first = F.get(keys, 0)
    root = _first_root_value(body, first, row_schema)
    return pages.select(
        F.col("service"), F.col("rent_dt"), F.col("start_index"), F.col("end_index"),
        _page_no(page_size).alias("page_no"),
        (F.coalesce(body, F.lit("")) != F.lit("")).alias("_has_body"),
        keys.alias("_keys"), first.alias("_first"),
        root.alias("_root"),
    )


def _page_flags(parsed: DataFrame, mode: str, page_size: int) -> DataFrame:
    """Adds ``ok`` (the page is read and yields rows) and ``stop_after`` (the
    client reads no page after it)."""
    n_rows = F.coalesce(F.size("_root.row"), F.lit(0))
    total = F.coalesce(F.col("_root.list_total_count").cast("long"), F.lit(0))
    requested_end = F.col("start_index") + F.lit(page_size - 1)
    base_ok = F.col("_has_body") & F.col("_first").isNotNull() & F.col("_root").isNotNull() & (n_rows > 0)
    if mode == "fact":
        ok = base_ok & (F.col("_first") != F.lit(RESULT_KEY))
        stop_after = requested_end >= total
    elif mode == "dim":
        ok = base_ok & ~F.coalesce(F.array_contains("_keys", RESULT_KEY), F.lit(False))
        stop_after = n_rows < page_size
    else:
        raise ValueError("mode must be 'fact' or 'dim'")
    return parsed.withColumn("ok", F.coalesce(ok, F.lit(False))) \
                 .withColumn("stop_after", F.coalesce(stop_after, F.lit(True))) \
                 .withColumn("n_rows", n_rows).withColumn("list_total_count", total)


def _same_group(a: str, b: str) -> Column:
    return (F.col(f"{a}.service").eqNullSafe(F.col(f"{b}.service"))
            & F.col(f"{a}.rent_dt").eqNullSafe(F.col(f"{b}.rent_dt")))


def _read_bound(flags: DataFrame) -> DataFrame:
    """Per group, the first page number NOT read: min(first failing page, page
    after the first stop page, first missing page). A page landed twice makes
    the answer ambiguous, so it fails the query instead of doubling rows."""
    meta = flags.where(F.col("page_no").isNotNull()).groupBy(*GROUP, "page_no").agg(
        F.count(F.lit(1)).alias("copies"),
        F.bool_and("ok").alias("ok"),
        F.bool_or("stop_after").alias("stop_after"),
    )
    per_group = meta.groupBy(*GROUP).agg(
        F.min(F.when(~F.col("ok"), F.col("page_no"))).alias("first_bad"),
        F.min(F.when(F.col("ok") & F.col("stop_after"), F.col("page_no") + 1)).alias("after_stop"),
        F.min("page_no").alias("min_page"),
        F.max("copies").alias("max_copies"),
    )
    nxt = meta.select(*[F.col(c).alias(f"n_{c}") for c in GROUP], (F.col("page_no") - 1).alias("n_prev"))
    no_successor = meta.alias("m").join(
        nxt.alias("x"),
        F.col("m.service").eqNullSafe(F.col("x.n_service"))
        & F.col("m.rent_dt").eqNullSafe(F.col("x.n_rent_dt"))
        & (F.col("m.page_no") == F.col("x.n_prev")),
        "left_anti")
    first_gap = no_successor.groupBy(*GROUP).agg((F.min("page_no") + 1).alias("gap_after_run"))
    b = per_group.alias("g").join(first_gap.alias("f"), _same_group("g", "f"), "left")
    missing = F.when(F.col("g.min_page") != 1, F.lit(1)).otherwise(F.col("f.gap_after_run"))
    bound = F.least(F.col("g.first_bad"), F.col("g.after_stop"), missing)
    duplicate = F.raise_error(F.concat(
        F.lit("page landed more than once for service="), F.coalesce(F.col("g.service"), F.lit("NULL")),
        F.lit(" rent_dt="), F.coalesce(F.col("g.rent_dt"), F.lit("NULL"))))
    return b.select(
        F.col("g.service").alias("service"), F.col("g.rent_dt").alias("rent_dt"),
        F.when(F.col("g.max_copies") > 1, duplicate.cast("long")).otherwise(bound).alias("read_bound"),
    )


def _pages_below(pages: DataFrame, bound: DataFrame, *extra: str) -> DataFrame:
    """``pages`` (with ``page_no``) below their group's bound, with the bound's ``extra`` columns.

    The key is (service, day, range of pages), with a row of the bound for each range:
    where the join is a shuffle, no task gets a whole day's bodies, and a NULL day (every
    page of a dimension) is as many keys as a long one. Broadcasting is left to AQE,
    which knows the bound's measured size."""
    ranges = bound.where(F.col("read_bound") > 1).select(
        *GROUP, "read_bound", *extra,
        F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(read_bound - 2) div {PAGES_TOGETHER}"))).alias("page_range"))
    p = pages.withColumn("page_range", F.expr(f"(page_no - 1) div {PAGES_TOGETHER}"))
    return (p.alias("p").join(ranges.alias("b"), _same_group("p", "b") & (F.col("p.page_range") == F.col("b.page_range")))
            .where(F.col("p.page_no") < F.col("b.read_bound"))
            .select(*[F.col(f"p.{c}") for c in pages.columns], *[F.col(f"b.{c}") for c in extra]))


def _collected(flags: DataFrame, bound: DataFrame) -> DataFrame:
    """Per group with a page that is read: pages read, rows collected, rows announced."""
    return _pages_below(flags, bound).groupBy(*GROUP).agg(
        F.count(F.lit(1)).alias("pages_read"),
        F.sum("n_rows").cast("long").alias("rows_collected"),
        F.max("list_total_count").alias("list_total_count"),
    )


def _announced(flags: DataFrame, bound: DataFrame) -> DataFrame:
    """The bound with its group's rows collected and announced."""
    j = bound.alias("b").join(_collected(flags, bound).alias("c"), _same_group("b", "c"), "left")
    return j.select("b.*", "c.rows_collected", "c.list_total_count")


def valid_pages(pages: DataFrame, row_schema: T.StructType, mode: str = "fact",
                page_size: int = PAGE_SIZE, observation: Observation | None = None,
                refuse_truncated: bool = False) -> DataFrame:
    """Pages the client would have read, with their parsed envelope. The bound
    comes from the cheap flag parse; only the pages below it are parsed with the
    row schema. ``observation`` and ``refuse_truncated``: see ``unpack_pages``."""
    flags = _page_flags(_parsed(pages, _ROW_PRESENCE, page_size), mode, page_size)
    bound = _read_bound(flags)
    raw = pages.select(*PAGE, _page_no(page_size).alias("page_no"))
    if observation is None and not refuse_truncated:
        return _parsed(_pages_below(raw, bound).select(*PAGE), row_schema, page_size)
    bound = _announced(flags, bound)
    short = F.col("rows_collected") < F.col("list_total_count")
    response = F.concat_ws(" ", F.col("service"), F.col("rent_dt"))
    if refuse_truncated:
        refused = F.raise_error(F.concat(
            F.lit("truncated response: "), response, F.lit(" has "), F.col("rows_collected").cast("string"),
            F.lit(" of "), F.col("list_total_count").cast("string"), F.lit(" rows"))).cast("boolean")
        bound = bound.where(F.when(short, refused).otherwise(F.lit(True)))
    kept = _pages_below(raw, bound, "rows_collected", "list_total_count")
    if observation is not None:
        first = F.col("page_no") == 1          # a response that is read at all has its first page read
        kept = kept.observe(
            observation,
            F.count_if(first).alias("responses"),
            F.count_if(first & short).alias("truncated"),
            F.coalesce(F.sum(F.when(first, F.col("list_total_count"))), F.lit(0)).alias("rows_announced"),
            F.coalesce(F.sum(F.when(first, F.col("rows_collected"))), F.lit(0)).alias("rows_collected"),
            F.min(F.when(short, response)).alias("first_truncated"))
    return _parsed(kept.select(*PAGE), row_schema, page_size)


def unpack_pages(pages: DataFrame, row_schema: T.StructType, mode: str = "fact",
                 page_size: int = PAGE_SIZE, keep_meta: bool = False, day_as: str | None = None,
                 observation: Observation | None = None, refuse_truncated: bool = False) -> DataFrame:
    """A1 (mode="fact") / A2 (mode="dim"): rows of the pages the client reads.

    fact: a page is read if its body is non-empty, its first root key is not
          RESULT and its row list is non-empty; reading stops after the page
          whose requested end index reaches list_total_count.
    dim:  a page is read if its body is non-empty, no root key is RESULT, the
          root value is an object and its row list is non-empty; reading stops
          after a page with fewer than ``page_size`` rows.
    Both stop at the first missing page. With ``keep_meta`` the page key and the
    row's position in its page are kept. ``day_as`` names a column for the day the
    page was asked for (the rows' own dates may differ).

    The landing gate (D7 at load): a response, the pages of one (service, day), is
    truncated when the pages read hold fewer rows than it announces. ``observation``
    gets the number of responses and of truncated ones, rows announced and collected, and
    the first truncated response's name, in the pass that writes the rows.
    ``refuse_truncated`` makes that pass fail on a truncated response, before anything is
    published. A response of which no page can be read announces nothing and is neither
    counted nor refused; ``page_audit`` lists it."""
    v = valid_pages(pages, _as_text(row_schema), mode, page_size, observation, refuse_truncated)
    # every valid page has rows, so the outer form yields the same rows; unlike the
    # inner form it adds no inferred size(row) > 0 filter, which Catalyst would push
    # below the projection and so evaluate the JSON parse a second time
    rows = v.select(*GROUP, "start_index", F.posexplode_outer("_root.row").alias("row_pos", "row")) \
            .where(F.col("row_pos").isNotNull())
    fields = [F.col(f"row.{f.name}").cast(f.dataType).alias(f.name) for f in row_schema.fields]
    if keep_meta:
        return rows.select(*GROUP, "start_index", "row_pos", *fields)
    if day_as:
        return rows.select(*fields, F.col("rent_dt").alias(day_as))
    return rows.select(*fields)


def unpack_pages_fact(pages: DataFrame, row_schema: T.StructType, **kw) -> DataFrame:
    return unpack_pages(pages, row_schema, "fact", **kw)


def unpack_pages_dim(pages: DataFrame, row_schema: T.StructType, **kw) -> DataFrame:
    return unpack_pages(pages, row_schema, "dim", **kw)


def page_ranges(totals: DataFrame, total_col: str = "list_total_count",
                page_size: int = PAGE_SIZE) -> DataFrame:
    """A3: the (start_index, end_index) pages requested for each total: 1..size,
    size+1..2*size, ... until the end index reaches the total (at least one)."""
    total = F.greatest(F.coalesce(F.col(total_col).cast("long"), F.lit(0)), F.lit(1))
    starts = F.sequence(F.lit(1).cast("long"), total, F.lit(page_size).cast("long"))
    keep = [c for c in totals.columns]
    out = totals.select(*keep, F.explode(starts).alias("start_index"))
    return out.withColumn("end_index", F.col("start_index") + F.lit(page_size - 1))


def page_audit(pages: DataFrame, row_schema: T.StructType, mode: str = "fact",
               page_size: int = PAGE_SIZE) -> DataFrame:
    """Per (service, rent_dt), pages landed vs read, rows collected vs the
    announced list_total_count. A truncated collection shows is_complete=false.
    Only page metadata is parsed (``row_schema`` is accepted for symmetry with
    ``unpack_pages`` and not needed)."""
    landed = pages.groupBy(*GROUP).agg(F.count(F.lit(1)).alias("pages_landed"))
    flags = _page_flags(_parsed(pages, _ROW_PRESENCE, page_size), mode, page_size)
    read = _collected(flags, _read_bound(flags))
    j = landed.alias("l").join(read.alias("r"), _same_group("l", "r"), "left")
    rows = F.coalesce(F.col("r.rows_collected"), F.lit(0)).cast("long")
    return j.select(
        F.col("l.service").alias("service"), F.col("l.rent_dt").alias("rent_dt"),
        F.col("l.pages_landed").alias("pages_landed"),
        F.coalesce(F.col("r.pages_read"), F.lit(0)).cast("long").alias("pages_read"),
        rows.alias("rows_collected"),
        F.col("r.list_total_count").alias("list_total_count"),
        (rows == F.col("r.list_total_count")).alias("is_complete"),
    )
