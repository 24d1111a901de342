"""The generic operators on the plain test tables, each with the SQL that must give the same rows.

Every entry reads its tables whole. The SQL is written the obvious way (joins, subqueries), so it
does not share the operators' reasoning.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.presence import all_missing, all_or_none, code_matches_label, label_contract, slots_match_count
from ..functions.presence import prefix_matches, timestamp_in_partition
from ..operators import digest, drift, findings, keys, ordered, profile, relations, shapes
from ..operators.relations import Relation
from ..session import materialize
from ..sources.records import record_problems
from ..streaming import review

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLE[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_lines(spark: SparkSession, sf_dir: str) -> Relation:
    return Relation("lineitem", table(spark, sf_dir, "lineitem"), ("l_orderkey",))


# --- keys, dependencies, ordinals -------------------------------------------------------------


@query("dup_key", """
SELECT count(*) AS duplicate_keys FROM (
  SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY ALL HAVING count(l_orderkey) > 1)
""")
def dup_key(spark, sf_dir):
    return keys.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("dup_key_by_month", """
SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS ship_month, count(*) AS duplicate_keys FROM (
  SELECT date_trunc('month', l_shipdate) AS l_shipdate, l_orderkey, l_linenumber, count(*) AS n
  FROM lineitem GROUP BY ALL) WHERE n > 1 GROUP BY ALL
""")
def dup_key_by_month(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").withColumn("ship_month", F.trunc(F.to_date("l_shipdate"), "month"))
    return keys.duplicate_keys(lines, ["l_orderkey", "l_linenumber"], ["ship_month"]).where("duplicate_keys > 0")


@query("dup_text", """
SELECT count(*) AS duplicate_keys FROM (SELECT text FROM documents GROUP BY text HAVING count(*) > 1)
""")
def dup_text(spark, sf_dir):
    """Texts that occur twice, by their digests: whole texts are not shuffled. NULL stays a key of its own."""
    texts = table(spark, sf_dir, "documents").select(F.sha2(F.col("text").cast("binary"), 256).alias("digest"))
    return keys.duplicate_keys(texts, ["digest"])


@query("fd_violation", """
SELECT count(*) AS violations FROM (
  SELECT l_orderkey FROM lineitem GROUP BY l_orderkey HAVING count(DISTINCT l_suppkey) > 1)
""")
def fd_violation(spark, sf_dir):
    return keys.dependency_violations(table(spark, sf_dir, "lineitem"), ["l_orderkey"], "l_suppkey")


@query("ordinal_gap", """
SELECT count(*) AS groups,
       count(*) FILTER (WHERE hi + 1 - lo <> n) AS gap_groups
FROM (SELECT min(l_linenumber) AS lo, max(l_linenumber) AS hi, count(l_linenumber) AS n FROM lineitem GROUP BY l_orderkey)
""")
def ordinal_gap(spark, sf_dir):
    return keys.ordinal_gaps(table(spark, sf_dir, "lineitem"), ["l_orderkey"], "l_linenumber")


@query("late_start", """
SELECT count(*) AS late_groups FROM (
  SELECT l_orderkey FROM lineitem GROUP BY l_orderkey HAVING min(l_linenumber) > 1)
""")
def late_start(spark, sf_dir):
    return keys.late_starts(table(spark, sf_dir, "lineitem"), ["l_orderkey"], "l_linenumber", base=1)


_SEQUENCES = """
WITH g AS (
  SELECT {group} AS k, min({ordinal}) AS lo, max({ordinal}) AS hi, count({ordinal}) AS n, count(DISTINCT {ordinal}) AS d
  FROM {table} GROUP BY 1)
SELECT count(*) AS groups,
       count(*) FILTER (WHERE lo <> {base} OR hi <> d + {base} - 1) AS bad_sets,
       count(*) FILTER (WHERE lo <> {base} OR hi <> d + {base} - 1 OR d <> n) AS bad_lists,
       (SELECT count(*) FROM (SELECT 1 FROM {table} GROUP BY {group}, {ordinal} HAVING count(*) > 1)) AS duplicate_keys
FROM g
"""


@query("ordinal_sequences", _SEQUENCES.format(group="l_orderkey", ordinal="l_linenumber", table="lineitem", base=1))
def ordinal_sequences(spark, sf_dir):
    return keys.ordinal_sequences(table(spark, sf_dir, "lineitem"), ["l_orderkey"], "l_linenumber", base=1)


@query("turn_sequences", _SEQUENCES.format(group="conv_id", ordinal="turn", table="conversations", base=0))
def turn_sequences(spark, sf_dir):
    return keys.ordinal_sequences(table(spark, sf_dir, "conversations"), ["conv_id"], "turn")


@query("nullable_ordinal_items", """
WITH items AS (
  SELECT l_orderkey, count(*) AS n, count(o) AS no, count(v) AS nv FROM (
    SELECT l_orderkey, CASE WHEN l_linenumber % 3 <> 0 THEN l_linenumber END AS o,
           CASE WHEN l_linenumber % 3 <> 0 AND l_quantity > 2 THEN l_quantity END AS v FROM lineitem)
  GROUP BY 1)
SELECT count(*) AS items, count(*) FILTER (WHERE NOT ((no = 0 AND n = 1 AND nv = 0) OR (no = n AND nv = n))) AS bad_items
FROM items
""")
def nullable_ordinal_items(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    ordinal = F.when(F.col("l_linenumber") % 3 != 0, F.col("l_linenumber"))
    value = F.when((F.col("l_linenumber") % 3 != 0) & (F.col("l_quantity") > 2), F.col("l_quantity"))
    items = lines.select("l_orderkey", ordinal.alias("o"), value.alias("v")).groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("rows"), F.count("o").alias("ordinals"), F.count("v").alias("values")
    )
    return items.agg(
        F.count(F.lit(1)).alias("items"),
        F.count_if(~keys.nullable_ordinal_item("rows", "ordinals", "values")).alias("bad_items"),
    )


# --- parents and children ---------------------------------------------------------------------


@query("orphan_orders", """
SELECT count(DISTINCT o_orderkey) AS orphan_keys FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
""")
def orphan_orders(spark, sf_dir):
    orders = Relation("orders", table(spark, sf_dir, "orders"), ("o_orderkey",))
    return relations.orphan_keys(orders, order_lines(spark, sf_dir))


@query("orphan_labels", """
SELECT count(DISTINCT doc_id) AS orphan_keys FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)
""")
def orphan_labels(spark, sf_dir):
    return relations.orphan_keys(
        Relation("labels", table(spark, sf_dir, "labels"), ("doc_id",)),
        Relation("documents", table(spark, sf_dir, "documents"), ("doc_id",)),
    )


@query("orphan_null_keys", """
WITH c AS (SELECT CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey END AS k, o_orderstatus AS s FROM orders),
     p AS (SELECT DISTINCT CASE WHEN l_orderkey % 5 <> 0 THEN l_orderkey END AS k, l_linestatus AS s FROM lineitem),
     d AS (SELECT DISTINCT k, s FROM c)
SELECT count(*) AS orphan_keys FROM d WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.k = d.k AND p.s = d.s)
""")
def orphan_null_keys(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderkey")).alias("k"), F.col("o_orderstatus").alias("s"))
    lines = table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_orderkey") % 5 != 0, F.col("l_orderkey")).alias("k"), F.col("l_linestatus").alias("s"))
    return relations.orphan_keys(Relation("orders", orders, ("k", "s")), Relation("lines", lines, ("k", "s")))


@query("key_set_diff", """
SELECT (SELECT count(DISTINCT doc_id) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)) AS only_left,
       (SELECT count(DISTINCT doc_id) FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)) AS only_right
""")
def key_set_diff(spark, sf_dir):
    return relations.key_set_difference(
        Relation("documents", table(spark, sf_dir, "documents"), ("doc_id",)),
        Relation("labels", table(spark, sf_dir, "labels"), ("doc_id",)),
    )


_DECLARED = """
WITH p AS (SELECT {parent_key} AS k, {declared} AS d FROM {parent}),
     c AS (SELECT l_orderkey AS k, count(*) AS n, min(l_linenumber) AS lo, max(l_linenumber) AS hi FROM lineitem GROUP BY 1)
SELECT 'lineitem' AS relation,
       count(*) FILTER (WHERE d <> coalesce(n, 0)) AS count_mismatches,
       count(*) FILTER (WHERE (d > 0 AND lo <> 1) OR (d > 0 AND hi <> d)) AS ordinal_mismatches
FROM p LEFT JOIN c USING (k)
"""


def _declared(spark, sf_dir, parents, key):
    lines = Relation("lineitem", table(spark, sf_dir, "lineitem"), ("l_orderkey",), ordinal="l_linenumber", base=1, declared="declared")
    return relations.declared_counts(Relation("parents", parents, (key,)), [lines])


@query("count_reconcile", _DECLARED.format(parent_key="o_orderkey", declared="o_orderkey % 8", parent="orders"))
def count_reconcile(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("declared", F.col("o_orderkey") % 8)
    return _declared(spark, sf_dir, orders, "o_orderkey")


@query("count_reconcile_repeated_parents", _DECLARED.format(
    parent_key="l_orderkey", declared="CASE WHEN l_partkey % 9 <> 8 THEN l_partkey % 9 END", parent="lineitem"))
def count_reconcile_repeated_parents(spark, sf_dir):
    parents = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", F.when(F.col("l_partkey") % 9 != 8, F.col("l_partkey") % 9).alias("declared"))
    return _declared(spark, sf_dir, parents, "l_orderkey")


@query("attr_agreement", """
SELECT count(*) AS mismatched_rows FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_linestatus <> o_orderstatus
""")
def attr_agreement(spark, sf_dir):
    orders = Relation("orders", table(spark, sf_dir, "orders"), ("o_orderkey",), attribute="o_orderstatus")
    lines = Relation("lineitem", table(spark, sf_dir, "lineitem"), ("l_orderkey",), attribute="l_linestatus")
    return relations.attribute_mismatches(lines, orders)


@query("attr_agreement_repeated", """
SELECT count(*) AS mismatched_rows FROM lineitem a JOIN lineitem b ON a.l_partkey = b.l_partkey
WHERE a.l_returnflag <> b.l_linestatus
""")
def attr_agreement_repeated(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return relations.attribute_mismatches(
        Relation("flags", lines, ("l_partkey",), attribute="l_returnflag"),
        Relation("status", lines, ("l_partkey",), attribute="l_linestatus"),
    )


@query("relation_summary", """
WITH k AS (SELECT o_orderkey AS k, count(*) AS np FROM orders GROUP BY 1),
     c AS (SELECT l_orderkey AS k, count(*) AS nc FROM lineitem GROUP BY 1)
SELECT 'lineitem' AS relation,
       (SELECT count(*) FROM c WHERE k NOT IN (SELECT k FROM k)) AS orphan_keys,
       (SELECT count(*) FROM k WHERE k NOT IN (SELECT k FROM c)) AS childless_keys,
       (SELECT count(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_linestatus <> o_orderstatus) AS mismatched_rows,
       (SELECT count(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderpriority <> '1-URGENT') AS flagged_rows,
       (SELECT count(*) FROM c WHERE nc > 1) AS duplicate_child_keys,
       (SELECT count(*) FROM k WHERE np > 1) AS duplicate_parent_keys
""")
def relation_summary(spark, sf_dir):
    orders = Relation("orders", table(spark, sf_dir, "orders"), ("o_orderkey",), attribute="o_orderstatus",
                      flag=F.col("o_orderpriority") != "1-URGENT")
    lines = Relation("lineitem", table(spark, sf_dir, "lineitem"), ("l_orderkey",), attribute="l_linestatus")
    return relations.key_agreement(orders, [lines])


@query("typed_parent_only", """
SELECT count(*) AS flagged_rows FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderpriority <> '1-URGENT'
""")
def typed_parent_only(spark, sf_dir):
    orders = Relation("orders", table(spark, sf_dir, "orders"), ("o_orderkey",), flag=F.col("o_orderpriority") != "1-URGENT")
    return relations.key_agreement(orders, [order_lines(spark, sf_dir)]).select("flagged_rows")


@query("missing_members", """
WITH h AS (SELECT DISTINCT CAST(ts AS DATE) AS day, CAST(hour(ts) AS INTEGER) AS hour, event_type AS member FROM events),
     s AS (SELECT DISTINCT day, hour FROM h)
SELECT day, hour, member FROM s, (VALUES ('click'), ('view'), ('purchase'), ('signup'), ('refund')) AS r(member)
WHERE NOT EXISTS (SELECT 1 FROM h WHERE h.day = s.day AND h.hour = s.hour AND h.member = r.member)
""")
def missing_members(spark, sf_dir):
    events = hourly_events(spark, sf_dir).withColumnRenamed("event_type", "member")
    return relations.absent_members(events, ["day", "hour"], events, "member", ["click", "view", "purchase", "signup", "refund"])


@query("unknown_members", """
SELECT DISTINCT CAST(ts AS DATE) AS day, event_type AS member FROM events WHERE event_type NOT IN ('click', 'view', 'purchase')
""")
def unknown_members(spark, sf_dir):
    events = hourly_events(spark, sf_dir).withColumnRenamed("event_type", "member")
    return relations.unknown_members(events, ["day"], "member", ["click", "view", "purchase"])


def hourly_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("day", F.to_date("ts")).withColumn("hour", F.hour("ts"))


# --- order ------------------------------------------------------------------------------------


@query("monotonic", """
SELECT count(DISTINCT l_orderkey) AS backward_groups FROM (
  SELECT l_orderkey, l_extendedprice AS v,
         lag(l_extendedprice) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_extendedprice) AS before
  FROM lineitem) WHERE v < before
""")
def monotonic(spark, sf_dir):
    return ordered.backward_groups(table(spark, sf_dir, "lineitem"), ["l_orderkey"], "l_linenumber", "l_extendedprice")


@query("monotonic_one_group", """
SELECT status AS o_orderstatus, count(*) FILTER (WHERE falls > 0) AS backward_groups FROM (
  SELECT o_orderstatus AS status, count(*) FILTER (WHERE v < before) AS falls FROM (
    SELECT o_orderstatus, o_orderdate AS v, lag(o_orderdate) OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) AS before
    FROM orders) GROUP BY 1) GROUP BY 1
""")
def monotonic_one_group(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("one", F.lit(1))
    return ordered.backward_groups(orders, ["one"], "o_orderkey", "o_orderdate", scope=["o_orderstatus"])


@query("monotonic_linked", """
SELECT count(DISTINCT l_orderkey) AS backward_groups FROM (
  SELECT l_orderkey, v, lag(v) OVER (PARTITION BY l_orderkey ORDER BY o, v) AS before FROM (
    SELECT a.l_orderkey, a.l_linenumber AS o, b.l_extendedprice AS v
    FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND a.l_partkey = b.l_partkey)) WHERE v < before
""")
def monotonic_linked(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return ordered.backward_children(lines, lines, ["l_orderkey"], "l_partkey", "l_linenumber", "l_extendedprice")


@query("monotonic_sparse", """
SELECT event_type, count(*) FILTER (WHERE falls > 0) AS backward_groups FROM (
  SELECT event_type, user_id, count(*) FILTER (WHERE value < before) AS falls FROM (
    SELECT event_type, user_id, value, lag(value) OVER (PARTITION BY event_type, user_id ORDER BY epoch_us(ts), value) AS before
    FROM events) GROUP BY 1, 2) GROUP BY 1
""")
def monotonic_sparse(spark, sf_dir):
    """Values along microseconds: ordinals far apart."""
    micros = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', ts)")
    events = table(spark, sf_dir, "events").withColumn("micros", micros)
    return ordered.backward_groups(events, ["user_id"], "micros", "value", scope=["event_type"])


# --- row contracts ----------------------------------------------------------------------------


@query("row_shapes", """
WITH s AS (
  SELECT *, CASE WHEN l_quantity > 10 THEN l_tax END AS a, CASE WHEN l_quantity > 10 OR l_linenumber = 7 THEN l_discount END AS b,
         CASE WHEN l_quantity > 45 THEN l_shipdate END AS c FROM lineitem)
SELECT "check", count FROM (
  SELECT count(*) FILTER (WHERE l_discount > 0.09) AS out_of_range,
         count(*) FILTER (WHERE l_returnflag <> l_linestatus) AS columns_differ,
         count(*) FILTER (WHERE (a IS NULL) <> (b IS NULL)) AS group_partly_set,
         count(*) FILTER (WHERE (a IS NULL) <> (l_returnflag = 'N')) AS flag_not_null_state,
         CAST(coalesce(sum(CASE WHEN l_linenumber = 1 THEN (a IS NULL)::INT + (b IS NULL)::INT + (c IS NULL)::INT END), 0) AS BIGINT) AS missing_cells_on_first,
         CAST(coalesce(sum(CASE WHEN l_linenumber > 1 THEN (a IS NOT NULL)::INT + (b IS NOT NULL)::INT + (c IS NOT NULL)::INT END), 0) AS BIGINT) AS present_cells_elsewhere,
         count(*) FILTER (WHERE a IS NULL AND b IS NULL AND c IS NULL) AS all_missing
  FROM s) UNPIVOT (count FOR "check" IN (out_of_range, columns_differ, group_partly_set, flag_not_null_state,
                   missing_cells_on_first, present_cells_elsewhere, all_missing))
""")
def row_shapes(spark, sf_dir):
    lines = _with_slots(table(spark, sf_dir, "lineitem"))
    first = F.col("l_linenumber") == 1
    cells = F.col("a").isNotNull().cast("int") + F.col("b").isNotNull().cast("int") + F.col("c").isNotNull().cast("int")
    return shapes.row_violations(lines, {
        "out_of_range": F.col("l_discount") > 0.09,
        "columns_differ": F.col("l_returnflag") != F.col("l_linestatus"),
        "group_partly_set": ~all_or_none(["a", "b"]),
        "flag_not_null_state": F.col("a").isNull() != (F.col("l_returnflag") == "N"),
        "missing_cells_on_first": F.when(first, 3 - cells),
        "present_cells_elsewhere": F.when(~first, cells),
        "all_missing": all_missing(["a", "b", "c"]),
    })


def _with_slots(lines: DataFrame) -> DataFrame:
    quantity = F.col("l_quantity")
    return (
        lines.withColumn("a", F.when(quantity > 10, F.col("l_tax")))
        .withColumn("b", F.when((quantity > 10) | (F.col("l_linenumber") == 7), F.col("l_discount")))
        .withColumn("c", F.when(quantity > 45, F.col("l_shipdate")))
    )


@query("slot_coverage", """
SELECT * FROM (SELECT count(*) AS total_rows,
    count(CASE WHEN l_quantity > 10 THEN l_tax END) AS a,
    count(CASE WHEN l_quantity > 10 OR l_linenumber = 7 THEN l_discount END) AS b,
    count(CASE WHEN l_quantity > 45 THEN l_shipdate END) AS c FROM lineitem) UNPIVOT (present FOR slot IN (a, b, c))
""")
def slot_coverage(spark, sf_dir):
    return shapes.slot_coverage(_with_slots(table(spark, sf_dir, "lineitem")), ["a", "b", "c"])


@query("presence_contract", """
SELECT count(*) FILTER (WHERE NOT CASE event_type WHEN 'purchase' THEN amt IS NOT NULL WHEN 'view' THEN amt IS NULL
       WHEN 'click' THEN amt IS NULL ELSE FALSE END) AS violations
FROM (SELECT event_type, CASE WHEN event_type = 'purchase' THEN value END AS amt FROM events)
""")
def presence_contract(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("amt", F.when(F.col("event_type") == "purchase", F.col("value")))
    contract = {"purchase": (["amt"], []), "view": ([], ["amt"]), "click": ([], ["amt"])}
    return events.agg(F.count_if(~label_contract("event_type", contract)).alias("violations"))


@query("slots_vs_count", """
SELECT count(*) FILTER (WHERE (c >= 1) <> (s0 IS NOT NULL) OR (c >= 2) <> (s1 IS NOT NULL)) AS violations FROM (
  SELECT l_linenumber % 5 AS c, CASE WHEN l_linenumber >= 1 AND l_quantity > 5 THEN 1 END AS s0,
         CASE WHEN l_linenumber >= 3 THEN 1 END AS s1 FROM lineitem)
""")
def slots_vs_count(spark, sf_dir):
    number = F.col("l_linenumber")
    lines = table(spark, sf_dir, "lineitem").select(
        (number % 5).alias("c"), F.when((number >= 1) & (F.col("l_quantity") > 5), 1).alias("s0"), F.when(number >= 3, 1).alias("s1"))
    return lines.agg(F.count_if(~slots_match_count("c", ["s0", "s1"])).alias("violations"))


@query("declared_length", """
SELECT count(*) FILTER (WHERE n_chars <> length(text)) AS char_mismatches,
       count(*) FILTER (WHERE n_chars <> octet_length(encode(text))) AS byte_mismatches FROM documents
""")
def declared_length(spark, sf_dir):
    return table(spark, sf_dir, "documents").agg(
        F.count_if(F.col("n_chars") != F.char_length("text")).alias("char_mismatches"),
        F.count_if(F.col("n_chars") != F.octet_length("text")).alias("byte_mismatches"),
    )


@query("prefix_contract", """
SELECT count(*) FILTER (WHERE NOT CASE WHEN n < 4 THEN p IS NULL ELSE p IS NOT DISTINCT FROM substring(s, 1, 4) END) AS violations
FROM (SELECT l_linenumber AS n, p_name AS s, CASE WHEN p_size > 25 THEN substring(p_name, 1, 4) WHEN p_size > 20 THEN 'none' END AS p
      FROM lineitem JOIN part ON l_partkey = p_partkey)
""")
def prefix_contract(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    prefix = F.when(F.col("p_size") > 25, F.substring("p_name", 1, 4)).when(F.col("p_size") > 20, F.lit("none"))
    joined = table(spark, sf_dir, "lineitem").join(parts, F.col("l_partkey") == F.col("p_partkey")).withColumn("p", prefix)
    return joined.agg(F.count_if(~prefix_matches("l_linenumber", "p_name", "p", 4)).alias("violations"))


@query("code_label", """
SELECT count(*) FILTER (WHERE (CASE o_orderstatus WHEN 'O' THEN 'open' WHEN 'F' THEN 'filled' END)
       IS DISTINCT FROM (CASE WHEN o_totalprice > 1000 THEN CASE o_orderstatus WHEN 'O' THEN 'open' WHEN 'F' THEN 'filled' ELSE 'partial' END END)) AS violations
FROM orders
""")
def code_label(spark, sf_dir):
    status = F.col("o_orderstatus")
    label = F.when(F.col("o_totalprice") > 1000, F.when(status == "O", "open").when(status == "F", "filled").otherwise("partial"))
    orders = table(spark, sf_dir, "orders").withColumn("label", label)
    return orders.agg(F.count_if(~code_matches_label("o_orderstatus", "label", {"O": "open", "F": "filled"})).alias("violations"))


@query("ts_partition", """
SELECT count(*) FILTER (WHERE CAST(ts AS DATE) <> CAST(ts + INTERVAL 10 MINUTE AS DATE)
                           OR hour(ts) <> hour(ts + INTERVAL 10 MINUTE)) AS hourly_violations,
       count(*) FILTER (WHERE CAST(ts AS DATE) <> CAST(ts + INTERVAL 10 MINUTE AS DATE)) AS daily_violations FROM events
""")
def ts_partition(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("later", F.expr("ts + INTERVAL '10' MINUTE"))
    day, hour = F.to_date("later"), F.hour("later")
    return events.agg(
        F.count_if(~timestamp_in_partition("ts", day, hour)).alias("hourly_violations"),
        F.count_if(~timestamp_in_partition("ts", day, F.lit(None).cast("int"))).alias("daily_violations"),
    )


# --- profiles and drift -----------------------------------------------------------------------


def _runs(spark: SparkSession, sf_dir: str, scope: list[str] = ()) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return keys.ordinal_ranges(lines, ["l_orderkey"], "l_linenumber", scope).withColumn("run", profile.run_length())


@query("distribution", """
SELECT count(run) AS count, CAST(min(run) AS BIGINT) AS minimum, median(run) AS median_value, CAST(max(run) AS BIGINT) AS maximum FROM (
  SELECT max(l_linenumber) - min(l_linenumber) + 1 AS run FROM lineitem GROUP BY l_orderkey)
""")
def distribution(spark, sf_dir):
    return profile.distribution(profile.histogram(_runs(spark, sf_dir), "run"))


@query("distribution_by_source", """
SELECT source, count(n_chars) AS count, min(n_chars) AS minimum, median(n_chars) AS median_value, max(n_chars) AS maximum
FROM documents GROUP BY source
""")
def distribution_by_source(spark, sf_dir):
    return profile.distribution(profile.histogram(table(spark, sf_dir, "documents"), "n_chars", ["source"]), ["source"])


@query("distribution_wide", """
SELECT event_type, count(k) AS count, min(k) AS minimum, median(k) AS median_value, max(k) AS maximum
FROM (SELECT event_type, CASE WHEN user_id % 10 <> 0 THEN user_id * 1000003 - event_id * 77 END AS k FROM events) GROUP BY event_type
""")
def distribution_wide(spark, sf_dir):
    key = F.when(F.col("user_id") % 10 != 0, F.col("user_id") * 1000003 - F.col("event_id") * 77)
    events = table(spark, sf_dir, "events").withColumn("k", key)
    return profile.distribution(profile.histogram(events, "k", ["event_type"]), ["event_type"])


_MONTH_RUNS = """
WITH r AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, l_orderkey, min(l_linenumber) AS lo,
                  max(l_linenumber) - min(l_linenumber) + 1 AS run
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2),
"""


def _month_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    months = table(spark, sf_dir, "orders").select("o_orderkey", F.trunc(F.to_date("o_orderdate"), "month").alias("month"))
    return _runs(spark, sf_dir).join(months, F.col("l_orderkey") == F.col("o_orderkey")).drop("o_orderkey")


@query("short_runs", _MONTH_RUNS + """
m AS (SELECT month, count(*) AS n, median(run) AS med, CAST(greatest(1, floor(median(run) / 2)) AS BIGINT) AS thr FROM r GROUP BY 1)
SELECT month, count(*) FILTER (WHERE run <= thr) AS short_runs, n AS run_count, med AS median_length, thr AS threshold_length
FROM r JOIN m USING (month) WHERE n >= 4 AND med >= 3 GROUP BY month, n, med, thr
HAVING count(*) FILTER (WHERE run <= thr) > 0 AND count(*) FILTER (WHERE run <= thr) < n
""")
def short_runs(spark, sf_dir):
    hist = profile.histogram(_month_ranges(spark, sf_dir), "run", ["month"])
    return profile.short_runs(hist, profile.distribution(hist, ["month"]), ["month"])


@query("tail_only", _MONTH_RUNS + """
t AS (SELECT month, count(*) FILTER (WHERE lo > 1) AS tail_only, count(*) AS group_count FROM r GROUP BY 1)
SELECT *, round(tail_only / group_count, 6) AS tail_share FROM t WHERE tail_only >= 3 AND tail_only / group_count >= 0.25
""")
def tail_only(spark, sf_dir):
    return profile.tail_only_excess(_month_ranges(spark, sf_dir), ["month"], base=1).withColumn("tail_share", F.round("tail_share", 6))


@query("label_mix", """
SELECT CAST(ts AS DATE) AS day, CAST(hour(ts) AS INTEGER) AS hour, event_type AS label, count(*) AS n,
       CAST(sum(count(*)) OVER (PARTITION BY CAST(ts AS DATE), hour(ts)) AS BIGINT) AS total,
       round(count(*) / sum(count(*)) OVER (PARTITION BY CAST(ts AS DATE), hour(ts)), 6) AS share
FROM events GROUP BY 1, 2, 3, hour(ts), CAST(ts AS DATE)
""")
def label_mix(spark, sf_dir):
    return profile.label_mix(hourly_events(spark, sf_dir), "event_type", ["day", "hour"]).withColumn("share", F.round("share", 6))


@query("peer_medians", """
WITH p AS (SELECT CAST(ts AS DATE) AS day, CAST(hour(ts) AS INTEGER) AS hour, count(*) AS n FROM events GROUP BY ALL)
SELECT a.day, a.hour, CAST(a.n AS BIGINT) AS n, count(*) AS peer_values, median(b.n) AS peer_median
FROM p a JOIN p b ON a.hour = b.hour AND a.day <> b.day GROUP BY ALL
""")
def peer_medians(spark, sf_dir):
    counts = hourly_events(spark, sf_dir).groupBy("day", "hour").agg(F.count(F.lit(1)).alias("n"))
    return drift.leave_one_out_medians(counts, ["hour"], "n", ["day"]).select("day", "hour", "n", "peer_values", "peer_median")


@query("count_drift", """
WITH p AS (SELECT CAST(ts AS DATE) AS day, CAST(hour(ts) AS INTEGER) AS hour, count(*) AS row_count,
                  count(DISTINCT user_id) AS users FROM events GROUP BY ALL),
     s AS (UNPIVOT p ON row_count, users INTO NAME metric VALUE value),
     j AS (SELECT a.day, a.hour, a.metric, a.value, median(b.value) AS med FROM s a JOIN s b
           ON a.hour = b.hour AND a.metric = b.metric AND a.day <> b.day GROUP BY ALL HAVING count(*) >= 3),
     r AS (SELECT *, greatest(value, med) / least(value, med) AS ratio FROM j
           WHERE greatest(value, med) / least(value, med) >= CASE metric WHEN 'row_count' THEN 1.5 ELSE 1.4 END AND abs(value - med) >= 1)
SELECT day, hour, count(*) AS drifted, string_agg(metric, ',' ORDER BY metric) AS metrics,
       arg_max(metric, ratio + CASE metric WHEN 'row_count' THEN 1e-9 ELSE 0 END) AS metric, round(max(ratio), 6) AS drift_ratio
FROM r GROUP BY day, hour
""")
def count_drift(spark, sf_dir):
    series = hourly_events(spark, sf_dir).groupBy("day", "hour").agg(
        F.count(F.lit(1)).alias("row_count"), F.countDistinct("user_id").alias("users"))
    found = drift.metric_drift(series, ["day", "hour"], ["hour"], {"row_count": (1.5, 1.0), "users": (1.4, 1.0)})
    return found.select("day", "hour", "drifted", "metrics", "metric", F.round("drift_ratio", 6).alias("drift_ratio"))


@query("mix_drift", """
WITH c AS (SELECT CAST(ts AS DATE) AS day, CAST(hour(ts) AS INTEGER) AS hour, event_type AS label, count(*) AS n FROM events GROUP BY ALL),
     p AS (SELECT day, hour, sum(n) AS total FROM c GROUP BY ALL),
     l AS (SELECT DISTINCT hour, label FROM c),
     s AS (SELECT p.day, p.hour, l.label, coalesce(c.n, 0) / p.total AS share FROM p JOIN l USING (hour)
           LEFT JOIN c ON c.day = p.day AND c.hour = p.hour AND c.label = l.label),
     j AS (SELECT a.day, a.hour, a.label, a.share, median(b.share) AS med FROM s a JOIN s b
           ON a.hour = b.hour AND a.label = b.label AND a.day <> b.day GROUP BY ALL HAVING count(*) >= 3),
     r AS (SELECT *, abs(share - med) AS difference FROM j WHERE abs(share - med) >= 0.35),
     w AS (SELECT *, row_number() OVER (PARTITION BY day, hour ORDER BY difference DESC, label) AS rn,
                  count(*) OVER (PARTITION BY day, hour) AS drifted FROM r)
SELECT day, hour, drifted, label, round(share, 6) AS share, round(med, 6) AS peer_median, round(difference, 6) AS difference FROM w WHERE rn = 1
""")
def mix_drift(spark, sf_dir):
    # One row per hour and label, read by several branches of the plan: computed once.
    mix = materialize(profile.label_mix(hourly_events(spark, sf_dir), "event_type", ["day", "hour"]))
    found = drift.mix_drift(mix, mix.select("day", "hour").distinct(), ["day", "hour"], ["hour"])
    return found.select("day", "hour", "drifted", "label", *[F.round(c, 6).alias(c) for c in ("share", "peer_median", "difference")])


_MIX_LANG = """
WITH c AS (SELECT CASE WHEN doc_id % 40 = 0 THEN 'odd' ELSE 'even' END || CAST(doc_id % 40 AS VARCHAR) AS part, doc_id % 2 AS cohort,
                  CASE WHEN doc_id % 40 IN (0, 3) THEN 'junk' WHEN doc_id % 40 = 6 AND lang <> 'en' THEN 'rare' ELSE 'text' END AS label, count(*) AS n
           FROM documents GROUP BY ALL),
     p AS (SELECT part, cohort, sum(n) AS total FROM c GROUP BY ALL),
     l AS (SELECT DISTINCT cohort, label FROM c),
     s AS (SELECT p.part, p.cohort, l.label, coalesce(c.n, 0) / p.total AS share FROM p JOIN l USING (cohort)
           LEFT JOIN c ON c.part = p.part AND c.cohort = p.cohort AND c.label = l.label),
     j AS (SELECT a.part, a.cohort, a.label, a.share, median(b.share) AS med FROM s a JOIN s b
           ON a.cohort = b.cohort AND a.label = b.label AND a.part <> b.part GROUP BY ALL HAVING count(*) >= 3),
     r AS (SELECT *, abs(share - med) AS difference FROM j WHERE abs(share - med) >= 0.35),
     w AS (SELECT *, row_number() OVER (PARTITION BY part, cohort ORDER BY difference DESC, label) AS rn,
                  count(*) OVER (PARTITION BY part, cohort) AS drifted FROM r)
SELECT part, cohort, drifted, label, round(share, 6) AS share, round(med, 6) AS peer_median, round(difference, 6) AS difference FROM w WHERE rn = 1
"""


@query("mix_drift_absent_label", _MIX_LANG)
def mix_drift_absent_label(spark, sf_dir):
    """Partitions that lack the usual label altogether: their share of it is an unwritten zero."""
    slot = F.col("doc_id") % 40
    documents = table(spark, sf_dir, "documents").select(
        F.concat(F.when(slot == 0, "odd").otherwise("even"), slot.cast("string")).alias("part"),
        (F.col("doc_id") % 2).alias("cohort"),
        F.when(slot.isin(0, 3), "junk").when((slot == 6) & (F.col("lang") != "en"), "rare").otherwise("text").alias("kind"),
    )
    mix = materialize(profile.label_mix(documents, "kind", ["part", "cohort"]))
    found = drift.mix_drift(mix, mix.select("part", "cohort").distinct(), ["part", "cohort"], ["cohort"])
    return found.select("part", "cohort", "drifted", "label", *[F.round(c, 6).alias(c) for c in ("share", "peer_median", "difference")])


# --- findings ---------------------------------------------------------------------------------


def _ship_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two rules over lineitem per ship day, as findings."""
    lines = table(spark, sf_dir, "lineitem").withColumn("part_id", F.unix_date(F.to_date("l_shipdate")) * 32)
    duplicates = keys.duplicate_keys(lines, ["l_orderkey", "l_linenumber"], ["part_id"]).where("duplicate_keys > 0")
    suppliers = keys.dependency_violations(lines, ["l_orderkey"], "l_suppkey", ["part_id"]).where("violations > 0")
    example = findings.example_json([("n", F.col("violations")), ("column", F.lit("l_suppkey"))])
    return findings.as_findings(duplicates, "duplicate_line", "lineitem", "duplicate_keys").unionByName(
        findings.as_findings(suppliers, "several_suppliers", "lineitem", "violations", example=example))


_SHIP = """
WITH d AS (SELECT CAST(l_shipdate AS DATE) AS day, l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL),
     s AS (SELECT CAST(l_shipdate AS DATE) AS day, l_orderkey, count(DISTINCT l_suppkey) AS n FROM lineitem GROUP BY ALL),
     f AS (SELECT 'duplicate_line' AS rule_id, day, count(*) AS count, NULL AS example FROM d WHERE n > 1 GROUP BY ALL
           UNION ALL SELECT 'several_suppliers', day, count(*), '{"column":"l_suppkey","n":' || count(*) || '}' FROM s WHERE n > 1 GROUP BY ALL)
"""
_SHIP_RULES = [("duplicate_line", "critical", "fail", "line repeats"), ("several_suppliers", "medium", "warn", "order has several suppliers")]


@query("findings_rollup", _SHIP + """
SELECT count(*) FILTER (WHERE rule_id = 'duplicate_line') AS fail_count, count(*) FILTER (WHERE rule_id = 'several_suppliers') AS warn_count,
       0::BIGINT AS metric_count, bool_or(rule_id = 'duplicate_line') AS has_failures,
       CASE WHEN bool_or(rule_id = 'duplicate_line') THEN 'critical' ELSE 'medium' END AS max_severity FROM f
""")
def findings_rollup(spark, sf_dir):
    rules = findings.rule_frame(spark, _SHIP_RULES)
    return findings.status_counts(findings.with_rule_defaults(_ship_findings(spark, sf_dir), rules))


@query("findings_by_rule", _SHIP + "SELECT rule_id, count(*) AS findings FROM f GROUP BY rule_id")
def findings_by_rule(spark, sf_dir):
    return findings.rule_counts(_ship_findings(spark, sf_dir))


@query("all_examples", _SHIP + "SELECT rule_id, day, count, example FROM f")
def all_examples(spark, sf_dir):
    rows = _ship_findings(spark, sf_dir).withColumn("day", F.date_from_unix_date(F.expr("part_id div 32").cast("int")))
    return rows.select("rule_id", "day", "count", "example")


@query("capped_examples", _SHIP + """
SELECT rule_id, day, count, CASE WHEN example IS NOT NULL AND row_number() OVER (PARTITION BY rule_id, example IS NULL ORDER BY day) <= 25 THEN example END AS example
FROM f
""")
def capped_examples(spark, sf_dir):
    rows = _ship_findings(spark, sf_dir).withColumn("day", F.date_from_unix_date(F.expr("part_id div 32").cast("int")))
    return findings.cap_examples(rows, ["day"], limit=25).select("rule_id", "day", "count", "example")


# --- incremental review -----------------------------------------------------------------------


def _event_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days of ``events``; a day counts as having files when it saw a refund after noon."""
    late = (F.col("event_type") == "refund") & (F.hour("ts") >= 12) & (F.col("value") > 0)
    return table(spark, sf_dir, "events").groupBy(F.to_date("ts").alias("partition_date")).agg(F.bool_or(late).alias("has_files"))


def _reviewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _event_days(spark, sf_dir).where(F.dayofmonth("partition_date") % 3 == 0).select("partition_date")


_DAYS = """
WITH days AS (SELECT CAST(ts AS DATE) AS partition_date, bool_or(event_type = 'refund' AND hour(ts) >= 12 AND value > 0) AS has_files FROM events GROUP BY 1),
     reviewed AS (SELECT partition_date FROM days WHERE day(partition_date) % 3 = 0),
     pending AS (SELECT * FROM days WHERE partition_date >= (SELECT max(partition_date) - 9 FROM days)
                 AND partition_date NOT IN (SELECT partition_date FROM reviewed))
"""


@query("pending_days", _DAYS + "SELECT * FROM pending")
def pending_days(spark, sf_dir):
    return review.pending_days(_event_days(spark, sf_dir), _reviewed(spark, sf_dir), 9)


@query("review_next", _DAYS + """
SELECT CASE WHEN min(partition_date) FILTER (WHERE has_files) IS NOT NULL THEN 'validated' WHEN count(*) > 0 THEN 'blocked' ELSE 'idle' END AS status,
       min(partition_date) FILTER (WHERE has_files) AS target_day,
       CASE WHEN min(partition_date) FILTER (WHERE has_files) IS NULL THEN min(partition_date) END AS blocked_day, count(*) AS pending_days FROM pending
""")
def review_next(spark, sf_dir):
    return review.next_review(_event_days(spark, sf_dir), _reviewed(spark, sf_dir), 9)


@query("review_advance", _DAYS + """
, target AS (SELECT min(partition_date) AS d FROM pending WHERE has_files)
SELECT partition_date FROM reviewed UNION SELECT d FROM target WHERE d IS NOT NULL
""")
def review_advance(spark, sf_dir):
    days, reviewed = _event_days(spark, sf_dir), _reviewed(spark, sf_dir)
    target = review.next_review(days, reviewed, 9).where("target_day IS NOT NULL")
    return reviewed.unionByName(target.select(F.col("target_day").alias("partition_date"))).distinct()


@query("upsert_snapshots", """
WITH c AS (SELECT CAST(ts AS DATE) AS partition_date, count(*) AS n, 'committed' AS origin FROM events WHERE event_type <> 'refund' GROUP BY 1),
     n AS (SELECT CAST(ts AS DATE) AS partition_date, count(*) AS n, 'current' AS origin FROM events WHERE event_type = 'refund' AND hour(ts) = 5 GROUP BY 1),
     k AS (SELECT c.* FROM c, (SELECT max(partition_date) AS top FROM c) WHERE partition_date >= top - 20 AND partition_date <= top)
SELECT * FROM k WHERE partition_date NOT IN (SELECT partition_date FROM n) UNION ALL SELECT * FROM n
""")
def upsert_snapshots(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("partition_date", F.to_date("ts"))

    def daily(rows: DataFrame, origin: str) -> DataFrame:
        return rows.groupBy("partition_date").agg(F.count(F.lit(1)).alias("n")).withColumn("origin", F.lit(origin))

    committed = daily(events.where("event_type <> 'refund'"), "committed")
    current = daily(events.where("event_type = 'refund' AND hour(ts) = 5"), "current")
    window = F.broadcast(committed.agg(F.max("partition_date").alias("_top")))
    bounded = committed.join(window, F.col("partition_date") <= F.col("_top"))
    kept = review.within_days(bounded, F.date_sub(F.col("_top"), 20), F.col("_top"), include_latest=True).drop("_top")
    return review.upsert_snapshots(kept, current, "partition_date")


# Each order as a JSON record; some are damaged, by customer. The same text in both engines.
_RECORD = """CASE o_custkey % 9 WHEN 2 THEN '{"key":"x"' WHEN 5 THEN '{"key":null' WHEN 6 THEN '{"key":0.5' ELSE '{"key":' || CAST(o_orderkey AS VARCHAR(20)) END
  || CASE o_custkey % 9 WHEN 1 THEN '' WHEN 7 THEN ',"status":null' ELSE ',"status":"' || o_orderstatus || '"' END
  || CASE o_custkey % 9 WHEN 3 THEN ',"more":1' ELSE '' END || CASE o_custkey % 9 WHEN 4 THEN '' ELSE '}' END"""


@query("strict_records", f"""
WITH r AS (SELECT {_RECORD} AS v FROM orders), ok AS (SELECT CASE WHEN json_valid(v) THEN v END AS v FROM r),
     f AS (SELECT v, json_keys(v) AS names, json_type(v, '$.key') AS k, json_type(v, '$.status') AS s FROM ok WHERE v IS NOT NULL),
     p AS (SELECT 'malformed' AS kind, NULL AS field FROM ok WHERE v IS NULL
           UNION ALL SELECT CASE WHEN NOT list_contains(names, 'key') THEN 'missing' WHEN k = 'NULL' THEN 'null' ELSE 'retyped' END, 'key'
             FROM f WHERE NOT list_contains(names, 'key') OR k NOT IN ('UBIGINT', 'BIGINT')
           UNION ALL SELECT CASE WHEN NOT list_contains(names, 'status') THEN 'missing' ELSE 'retyped' END, 'status'
             FROM f WHERE NOT list_contains(names, 'status') OR s NOT IN ('VARCHAR', 'NULL')
           UNION ALL SELECT 'extra', n FROM (SELECT unnest(names) AS n FROM f) WHERE n NOT IN ('key', 'status'))
SELECT kind, field, count(*) AS records FROM p GROUP BY kind, field
""")
def strict_records(spark, sf_dir):
    """JSON records checked field by field before they are decoded."""
    records = table(spark, sf_dir, "orders").select(F.expr(_RECORD).alias("value"))
    problems = record_problems(records, "key bigint NOT NULL, status string").select(F.explode("problems").alias("p"))
    return problems.groupBy("p.kind", "p.field").agg(F.count(F.lit(1)).alias("records"))


# --- digests ----------------------------------------------------------------------------------


@query("digest_verify", """
SELECT source, count(*) AS rows, count(*) FILTER (WHERE stored <> sha256(text)) AS mismatches FROM (
  SELECT source, text, CASE WHEN doc_id % 97 = 5 THEN sha256(text || 'x') ELSE sha256(text) END AS stored FROM documents) GROUP BY source
""")
def digest_verify(spark, sf_dir):
    text = F.col("text")
    stored = F.unhex(F.sha2(F.when(F.col("doc_id") % 97 == 5, F.concat(text, F.lit("x"))).otherwise(text).cast("binary"), 256))
    documents = table(spark, sf_dir, "documents").select("source", text.cast("binary").alias("payload"), stored.alias("stored"))
    return digest.digest_mismatches(documents, "payload", "stored", "sha2-256", ["source"])


@query("digest_verify_keccak", """
SELECT source, count(*) AS rows, count(*) FILTER (WHERE doc_id % 97 = 5) AS mismatches FROM documents GROUP BY source
""")
def digest_verify_keccak(spark, sf_dir):
    """Keccak of every whole text against stored digests, some of which belong to a changed text."""
    text = F.col("text")
    written = F.when(F.col("doc_id") % 97 == 5, F.concat(text, F.lit("x"))).otherwise(text).cast("binary")
    documents = table(spark, sf_dir, "documents").select("source", text.cast("binary").alias("payload"), written.alias("written"))
    rows = documents.withColumn("stored", digest.digest("written", "keccak256"))
    return digest.digest_mismatches(rows, "payload", "stored", "keccak256", ["source"])


# Keccak-256 of event types written so many times, computed with another program (a command-line digest tool).
# 17 times "purchase" and 34 times "view" fill one block exactly.
_KECCAK_KNOWN = """
  ('click', 0, 'c5d2460186f7233c927e7db2dcc703c0e500b653ca82273b7bfad8045d85a470'),
  ('click', 1, 'f951a0ddf328b260ac5f48f21cc51687d0414317e8a5a8ea44f05aebb4c440e9'),
  ('click', 17, '635112eafe7d39671d027867b1adb6278d6e6df4600664cc6d686552cd20d22b'),
  ('click', 34, 'e48f59e648482e49475abcf44a4c5172ae22af9d0a40270a329b7cc4940304a0'),
  ('click', 100, 'a57219c19bf3dab2994b15544d5b89b6b7d324dc93d068c58e856191e9c69f3a'),
  ('error', 0, 'c5d2460186f7233c927e7db2dcc703c0e500b653ca82273b7bfad8045d85a470'),
  ('error', 1, '177f242d20ff7dc4598657e4355abd2b0df8f6351283a95d209db56ce73ef6e9'),
  ('error', 17, 'e11afdd921e24431914ff252408619fa836e86ea466b3000041b6d63aae79ce1'),
  ('error', 34, 'b92219913b4c1fa2558a540052295578150c01808d1650d9168e6385b718d38d'),
  ('error', 100, 'b779bac2928df3463593d0457601bd0c2a180520e82964289199ec83ded2cf65'),
  ('purchase', 0, 'c5d2460186f7233c927e7db2dcc703c0e500b653ca82273b7bfad8045d85a470'),
  ('purchase', 1, '21a54c395fa140984a9b0a773962386ef9665bf65bb9734960d63d151542c541'),
  ('purchase', 17, 'c063b2872dda84f293dab8260d4a3c8e655c1d456f0f272fd6b848a2952d8787'),
  ('purchase', 34, '7925edb598509c159dd10974d8b6b7f5f505fc184848ab1f42cdda123b220165'),
  ('purchase', 100, 'c21760fea3375439e517075b60030a74256769633e845fd3a8558be5a0ae3517'),
  ('signup', 0, 'c5d2460186f7233c927e7db2dcc703c0e500b653ca82273b7bfad8045d85a470'),
  ('signup', 1, 'cb489c5d75748aae0d3aab3622fa460f1072fe17bff252f4190272345704e8fa'),
  ('signup', 17, '99bc567e1731f8171eda09cfb51856667de016a35c33e61896b3dc56908cb2da'),
  ('signup', 34, '606a3ac9e86b5c890372f2047256918b05b69e6366ffd47795f2e6e97f098c5b'),
  ('signup', 100, '0252a296493b95960b219dffc6e484b37a4d0ba44a51eb6364973e30dcbf899f'),
  ('view', 0, 'c5d2460186f7233c927e7db2dcc703c0e500b653ca82273b7bfad8045d85a470'),
  ('view', 1, 'a2bc7e44b5b38a37bc3b2ca074a599881db3d4c473713cb905559dfe2722a896'),
  ('view', 17, 'c9175b6018bd5a802b39d737146b9a607d98ff0618499a10f9ef0aa54bc47277'),
  ('view', 34, '4ba3aebdc3d3dc3655f5fb75ba8bc83c6b154e81257185ced43d2854dd0d5cf6'),
  ('view', 100, 'c641daf3d30338a0534d4751147bea37d54875f819e7416d4967abfe61852481')
"""
_COPIES = (0, 1, 17, 34, 100)


@query("keccak_known_values", f"""
WITH known(event_type, copies, digest) AS (VALUES {_KECCAK_KNOWN}),
     e AS (SELECT event_type, unnest([0, 1, 17, 34, 100]) AS copies FROM events)
SELECT event_type, e.copies, digest, count(*) AS rows FROM e LEFT JOIN known USING (event_type, copies) GROUP BY event_type, e.copies, digest
""")
def keccak_known_values(spark, sf_dir):
    """Keccak of every event's type, written several times: lengths of none, one, just one and several blocks."""
    copies = F.explode(F.array(*map(F.lit, _COPIES))).alias("copies")
    events = table(spark, sf_dir, "events").select("event_type", copies)
    payload = F.expr("repeat(event_type, copies)").cast("binary")
    hashed = events.select("event_type", "copies", F.lower(F.hex(digest.digest(payload, "keccak256"))).alias("digest"))
    return hashed.groupBy("event_type", "copies", "digest").agg(F.count(F.lit(1)).alias("rows"))
