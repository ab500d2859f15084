"""Queries beyond the jobs' own operators, each with the SQL that checks it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.bindings.raw import RAW, load, raw_frame, raw_sql
from starmart.operators import asof, changes, frames, intervals, quality, sketches
from starmart.plans import silver
from starmart.session import scratch_path
from starmart.sources import nested, readers, writers
from starmart.streaming import marks
from starmart.streaming.merge import merge_snapshot
from starmart.streaming.stream import stream_load

EXTENDED: dict = {}
EXTENDED_SQL: dict[str, str] = {}


def checked_by(sql: str):
    def register(build):
        EXTENDED[build.__name__] = build
        EXTENDED_SQL[build.__name__] = sql
        return build

    return register


# Versions of the orders: each part is a select list and the condition of its rows, read alike by both engines.

_ORDER = "nullif(o_orderkey, 7) as order_id, o_custkey as customer_id, {} as order_status, o_totalprice as total"
_BEFORE = [(_ORDER.format("o_orderstatus"), "o_orderpriority <> '5-LOW'"), (_ORDER.format("o_orderstatus"), "o_orderpriority = '1-URGENT'")]
_CHANGED = "case when o_orderpriority = '2-HIGH' then null else o_orderstatus end"
_AFTER = [(_ORDER.format(_CHANGED), "o_orderstatus <> 'P'"), (_ORDER.format("'again'"), "o_orderpriority = '3-MEDIUM' and o_orderstatus = 'F'")]


def _version(spark, folder, parts, source="orders") -> DataFrame:
    table = load(spark, folder, source)
    frames_of = [table.where(where).selectExpr(*_split(select)) for select, where in parts]
    return reduce(DataFrame.unionAll, frames_of)


def _split(select: str) -> list[str]:
    """Items of a select list: commas outside parentheses divide them."""
    items, depth = [""], 0
    for letter in select:
        depth += (letter == "(") - (letter == ")")
        if letter == "," and not depth:
            items.append("")
        else:
            items[-1] += letter
    return items


def _version_sql(parts, source="orders") -> str:
    return " union all ".join(f"select {select} from {source} where {where}" for select, where in parts)


@checked_by(
    "select doc_id, lang, source, replace(text, chr(10), chr(13) || chr(10)) as text, n_chars from documents"
)
def src_csv_multiline(spark, folder):
    """One writer's files of any size, with line breaks of two kinds in quotes, read by byte ranges."""
    documents = load(spark, folder, "documents").withColumn("text", F.replace("text", F.lit("\n"), F.lit("\r\n")))
    path = scratch_path(spark, "multiline_csv")
    writers.write_csv(documents, path, bytes_per_file=1 << 50)
    types = {f.name: f.dataType.simpleString() for f in documents.schema}
    return readers.read_csv(spark, path, types, multi_line=True)


@checked_by(
    f"""with b as ({_version_sql(_BEFORE)}), a as ({_version_sql(_AFTER)}),
    gone as (select *, count(*) as copies from (select * from b except all select * from a) group by all),
    come as (select *, count(*) as copies from (select * from a except all select * from b) group by all)
    select case when exists (select 1 from a where a.order_id is not distinct from gone.order_id) then 'update_old' else 'delete' end as change,
        copies, order_id, customer_id, order_status, total from gone
    union all select case when exists (select 1 from b where b.order_id is not distinct from come.order_id) then 'update_new' else 'insert' end,
        copies, order_id, customer_id, order_status, total from come"""
)
def inc_change_capture(spark, folder):
    return changes.row_changes(_version(spark, folder, _BEFORE), _version(spark, folder, _AFTER), ["order_id"])


_DATED = "o_orderkey as order_id, {} as order_status, o_totalprice as total, cast(year(o_orderdate) as int) as year"
_OLD_YEARS = [(_DATED.format("o_orderstatus"), "o_orderpriority <> '5-LOW'")]
_NEW_YEARS = [(_DATED.format(_CHANGED), "o_orderstatus <> 'P' and year(o_orderdate) <> 1995")]


@checked_by(_version_sql(_NEW_YEARS))
def inc_merge_snapshot(spark, folder):
    """A target brought from one version of the orders to the next, in which a whole directory vanishes."""
    path = scratch_path(spark, "merge_target")
    for version in (_OLD_YEARS, _NEW_YEARS):
        merge_snapshot(spark, _version(spark, folder, version), key=["order_id"], target_path=path, partition_by=("year",))
    return readers.read_parquet(spark, path).select("order_id", "order_status", "total", "year")


def _orders_sql() -> str:
    from starmart.bindings.oracle import SILVER

    return SILVER["orders"]


def inc_stream_orders(spark, folder):
    """Orders that arrive in three drops of files, one run for each, and a fourth after the first drop came again."""
    raw = raw_frame(spark, folder, "orders")
    source, target, checkpoint = (scratch_path(spark, f"stream_{x}") for x in ("source", "target", "checkpoint"))
    year = F.substring("order_purchase_timestamp", 1, 4).cast("int")
    early, late = F.coalesce(year < 1995, F.lit(True)), year >= 1998
    for drop in (raw.where(early), raw.where(~early & ~late), raw.where(late), raw.where(early)):
        writers.append_parquet(drop, source)
        stream_load(
            spark, silver.order_candidates, silver.finish_orders, source_path=source, schema=raw.schema, ts="purchase_ts", delay="10 days",
            target_path=target, checkpoint_path=checkpoint, partition_by=("year",),
        )
    shape = silver.orders(raw, marks.START)
    return readers.read_parquet(spark, target, shape.schema).select(*shape.columns)


_PURCHASES = "event_id, nullif(user_id, 3) as user_id, ts, value"


@checked_by(
    """select p.event_id, p.user_id, p.ts, p.value, v.view_id, v.view_value
    from (select event_id, nullif(user_id, 3) as user_id, ts, value from events where event_type = 'purchase') p
    asof left join (
        select user_id, ts, max(event_id) as view_id, arg_max(value, event_id) as view_value
        from events where event_type = 'view' group by user_id, ts
    ) v on p.user_id = v.user_id and p.ts >= v.ts"""
)
def join_asof_events(spark, folder):
    """Each purchase with its user's latest view."""
    events = load(spark, folder, "events")
    bought = events.where("event_type = 'purchase'").selectExpr(*_split(_PURCHASES))
    seen = events.where("event_type = 'view'").selectExpr("user_id", "ts as seen_ts", "event_id as view_id", "value as view_value")
    return asof.asof_join(bought, seen, ["user_id"], "ts", "seen_ts", ["view_id", "view_value"], ties=["view_id"])


@checked_by(
    """with c as (select event_id, user_id, ts as a, ts + to_minutes(cast(floor(value * case when value > 250 then 60 else 1 end) as int)) as b
        from events where event_type = 'click'),
    e as (select event_id, user_id, ts - interval 45 minute as a, ts + interval 45 minute as b from events where event_type = 'error')
    select c.event_id as click_id, e.event_id as error_id, greatest(c.a, e.a) as both_from, least(c.b, e.b) as both_to
    from c join e on c.user_id = e.user_id and c.a < e.b and e.a < c.b and c.a < c.b"""
)
def join_interval(spark, folder):
    """Visits (some of ten days and more) and the times around errors of the same user, where they overlap."""
    events = load(spark, folder, "events")
    minutes = "cast(floor(value * case when value > 250 then 60 else 1 end) as int)"
    visits = events.where("event_type = 'click'").selectExpr("event_id", "user_id", "ts as a", f"ts + make_dt_interval(0, 0, {minutes}) as b")
    errors = events.where("event_type = 'error'").selectExpr("event_id", "user_id", "ts - interval '45' minute as a", "ts + interval '45' minute as b")
    met = intervals.overlap_join(visits, errors, ("a", "b"), ("a", "b"), ["user_id"])
    return met.select(
        F.col("left.event_id").alias("click_id"), F.col("right.event_id").alias("error_id"),
        F.greatest("left.a", "right.a").alias("both_from"), F.least("left.b", "right.b").alias("both_to"),
    )


_SOLD = "cast(year(o_orderdate) as int) as year, cast(month(o_orderdate) as int) as month, nullif(o_orderstatus, 'P') as status, o_totalprice"


@checked_by(
    f"""select year, month, status, cast(grouping_id(year, month, status) as int) as level_id,
        cast(sum(cast(o_totalprice as decimal(18,2))) as double) as revenue, count(*) as n_rows
    from (select {_SOLD} from orders) group by cube (year, month, status)"""
)
def agg_revenue_cube(spark, folder):
    """Orders without a status are a group of their own beside the totals."""
    return frames.revenue_cube(load(spark, folder, "orders").selectExpr(*_split(_SOLD)), ["year", "month", "status"], "o_totalprice")


@checked_by(
    """with d as (select o_orderstatus as status, cast(o_orderdate as date) as day, sum(cast(o_totalprice as decimal(18,2))) as s
        from orders where o_orderdate is not null group by all)
    select status, day, cast(s as double) as revenue, cast(sum(s) over (
        partition by status order by day range between interval 6 day preceding and current row) as double) as trailing from d"""
)
def agg_trailing_revenue(spark, folder):
    sold = load(spark, folder, "orders").selectExpr("o_orderstatus as status", "cast(o_orderdate as date) as day", "o_totalprice")
    return frames.trailing_sum(sold, ["status"], "day", "o_totalprice", 7)


@checked_by(
    """select o_orderkey as order_id, o_orderstatus as status, o_orderdate as at, o_totalprice as price,
        cast(sum(cast(o_totalprice as decimal(18,2))) over (
            partition by o_orderstatus order by o_orderdate, o_orderkey rows unbounded preceding) as double) as running
    from orders"""
)
def agg_running_total(spark, folder):
    """Three statuses are three hot keys; each is added up month by month."""
    sold = load(spark, folder, "orders").selectExpr("o_orderkey as order_id", "o_orderstatus as status", "o_orderdate as at", "o_totalprice as price")
    return frames.running_total(sold, ["status"], "at", ["order_id"], "price")


_PROPS = """case event_type when 'view' then props
    when 'click' then replace(props, '}', ', "tags": ["B ", "a", "b", " "]}')
    when 'purchase' then replace(replace(props, ': ', ': "'), '}', '", "new": true, "at": {"x": 1}}')
    when 'error' then replace(props, '}', '') end"""


@checked_by(
    f"""with e as (select event_id, {_PROPS} as p from events),
    j as (select event_id, p, coalesce(json_valid(p), false) as ok from e),
    t as (select *, case when ok then json_extract_string(p, '$.tags[*]') end as raw from j)
    select event_id, case when ok then try_cast(json_extract_string(p, '$.k') as bigint) end as k,
        case when ok and len(raw) > 0 then array_to_string(list_sort(list_distinct([lower(trim(x)) for x in raw if trim(x) <> ''])), '|') end as tags,
        case when ok then array_to_string(list_sort([x for x in json_keys(p) if x not in ('k', 'tags')]), '|') end as extra,
        p is not null and not ok as malformed
    from t"""
)
def src_json_props(spark, folder):
    """Event properties whose fields drift: a number in quotes, new fields, an array, and text that is no JSON."""
    events = load(spark, folder, "events").selectExpr("event_id", f"{_PROPS} as p")
    found = nested.json_fields(events, "p", {"k": "bigint", "tags": "array<string>"})
    return found.select(
        "event_id", "k", F.array_join(nested.clean_labels("tags"), "|").alias("tags"), F.array_join("extra_fields", "|").alias("extra"), "malformed"
    )


@checked_by(
    """select 'total' as column_name, count(*) as n_rows, 0::bigint as n_null, true as distinct_near, true as median_near from orders
    union all select 'customer_id', count(*), count(*) filter (o_custkey is null), true, true from orders
    union all select 'order_status', count(*), count(*) filter (nullif(o_orderstatus, 'P') is null), true, true from orders"""
)
def dq_sketch_report(spark, folder):
    """Sketches of three loads, appended one by one and merged; estimates against exact numbers, within their bounds."""
    orders = load(spark, folder, "orders").selectExpr("o_custkey as customer_id", "nullif(o_orderstatus, 'P') as order_status", "o_totalprice as total", "o_orderdate")
    path = scratch_path(spark, "sketches")
    early, late = F.coalesce(F.col("o_orderdate") < "1995-01-01", F.lit(True)), F.col("o_orderdate") >= "1998-01-01"
    for name, part in (("first", early), ("second", ~early & ~late), ("third", late)):
        made = sketches.load_sketches(orders.where(part), name, ["customer_id", "order_status"], ["total"])
        writers.append_parquet(made, path)
    report = sketches.sketch_report(readers.read_parquet(spark, path))
    median = report.where("column_name = 'total'").select(F.col("p50").alias("_median"))
    names = ("customer_id", "order_status", "total")
    # One row of exact numbers, and one of the median: both sides of this product have a single row.
    exact = orders.join(F.broadcast(median)).agg(
        *[F.countDistinct(n).alias(n) for n in names], F.avg((F.col("total") <= F.col("_median")).cast("int")).alias("_rank")
    )
    listed = F.inline(F.array(*[F.struct(F.lit(n).alias("of_column"), F.col(n).alias("exact"), F.col("_rank")) for n in names]))
    met = report.join(exact.select(listed), F.col("column_name") == F.col("of_column"))
    return met.select(
        "column_name", "n_rows", "n_null", (F.abs(F.col("n_distinct") - F.col("exact")) <= 0.06 * F.col("exact")).alias("distinct_near"),
        F.when(F.col("p50").isNull(), True).otherwise(F.abs(F.col("_rank") - 0.5) <= 0.03).alias("median_near"),
    )


# Keys ---------------------------------------------------------------------------------

_CLEANED = {
    "orders": lambda raw: silver.orders(raw, marks.START),
    "reviews": lambda raw: silver.reviews(raw, marks.START),
    **{name: getattr(silver, name) for name in ("customers", "products", "sellers", "order_items", "payments", "category_translation", "geolocation")},
}


def _cleaned(spark, folder) -> dict[str, DataFrame]:
    return {name: clean(raw_frame(spark, folder, name)) for name, clean in _CLEANED.items()}


def dq_orphans(spark, folder):
    return quality.orphan_report_all(_cleaned(spark, folder))


def dq_join_keys(spark, folder):
    return quality.repeated_keys_all(_cleaned(spark, folder))


def _orphans_sql() -> str:
    from starmart.bindings.oracle import SILVER

    def one(fk: quality.ForeignKey) -> str:
        child, parent = f"({SILVER[fk.table]})", f"({SILVER[fk.parent]})"
        return f"""select '{fk.table}' as table_name, '{fk.column}' as key_name, '{fk.parent}' as parent_name, n_rows, null_rows, matched_rows,
            orphan_rows, orphan_keys, joined_rows
        from (select count(*) as n_rows, count(*) filter (k is null) as null_rows, count(*) filter (found) as matched_rows,
                count(*) filter (k is not null and not found) as orphan_rows,
                count(distinct case when not found then k end) as orphan_keys
            from (select {fk.column} as k, {fk.column} is not null and {fk.column} in (
                select {fk.parent_column} from {parent} where {fk.parent_column} is not null) as found from {child})),
            (select count(*) as joined_rows from {child} c left join {parent} p on c.{fk.column} = p.{fk.parent_column})"""

    return " union all ".join(one(fk) for fk in quality.FOREIGN_KEYS)


def _join_keys_sql() -> str:
    from starmart.bindings.oracle import SILVER

    def one(name: str, key: list[str]) -> str:
        return f"""select '{name}' as table_name, '{"_".join(key)}' as key_name, count(*) as n_keys, count(*) filter (n > 1) as repeated_keys,
            coalesce(max(n), 0) as most_rows, cast(coalesce(sum(n - 1), 0) as bigint) as extra_rows
        from (select count(*) as n from ({SILVER[name]}) where {" and ".join(f"{k} is not null" for k in key)} group by {", ".join(key)})"""

    return " union all ".join(one(name, key) for name, key in quality.UNIQUE_KEYS.items())


# Malformed text -----------------------------------------------------------------------

_TEXT_TYPES = {
    "order_item_id": "int",
    "price": "double",
    "freight_value": "double",
    "shipping_limit_date": "timestamp",
}


def _items_as_text() -> list[str]:
    """Order lines as text with dirt: words, a decimal comma, a fraction in a whole number, blanks, unreadable times."""
    columns = RAW["order_items"].columns
    return [
        "l_orderkey",
        "case when l_linenumber = 3 then '3.0' when l_linenumber = 4 then ' ' else cast(l_linenumber as string) end as order_item_id",
        "case when l_returnflag = 'R' then 'n/a' when l_quantity = 50 then '' else cast(cast(l_quantity as int) as string) end as price",
        "case when l_quantity = 1 then '1,5' when l_quantity = 2 then null else '-0.5e1' end as freight_value",
        f"{columns['shipping_limit_date']} as shipping_limit_date",
    ]


def dq_malformed(spark, folder):
    lines = load(spark, folder, "lineitem").selectExpr(*_items_as_text())
    return quality.malformed_report(lines, _TEXT_TYPES)


def _malformed_sql() -> str:
    kinds = {"int": "integer", "double": "double", "timestamp": "timestamp"}

    def bad(name: str, kind: str) -> str:
        whole = f" or {name} like '%.%'" if kind == "int" else ""
        return f"{name} is not null and trim({name}) <> '' and (try_cast({name} as {kinds[kind]}) is null{whole})"

    table = f"(select {', '.join(_items_as_text())} from lineitem)"
    return " union all ".join(
        f"select 'malformed_{n}' as metric_name, count(*) filter ({bad(n, k)}) as metric_value, min(case when {bad(n, k)} then {n} end) as example from {table}"
        for n, k in _TEXT_TYPES.items()
    )


def register_all() -> None:
    """Queries whose SQL is put together from that of the cleaned tables."""
    for build, sql in (
        (inc_stream_orders, _orders_sql()),
        (dq_orphans, _orphans_sql()),
        (dq_join_keys, _join_keys_sql()),
        (dq_malformed, _malformed_sql()),
    ):
        checked_by(sql)(build)
