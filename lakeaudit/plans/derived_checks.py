"""The rule pack on tables that Spark derives from ``orders`` and ``lineitem``.

Each order becomes a flashblock and each line a transaction, receipt, log and so on, with defects
that depend on key and value arithmetic, so every rule has something to find at any scale. The
derivation is one SQL text for both engines; the rules on the DuckDB side are spelled out with joins.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.columns import ordered_long
from ..functions.scope import part_date, part_hour
from ..session import materialize, settle
from . import baseline, rulepack
from .rulepack import ACCESS, AUTHORIZATIONS, BALANCES, BLOCKS, LOGS, RECEIPTS, TRANSACTIONS, WITHDRAWALS
from .table_checks import query, table

_PAYLOAD = "CAST(floor(k / 4) AS BIGINT)"
_PART = "CAST((18262 + p % 30) * 32 + p % 3 + 1 AS INTEGER)"
_INDEX = "CASE WHEN k % 97 = 0 THEN 0 ELSE k % 4 END"
_BLOCK = "(CASE WHEN p % 150 = 30 THEN p - 30 ELSE p END) * 10 + CASE WHEN k % 53 = 0 THEN 1 ELSE 0 END"
_HASH = "CASE WHEN k % 2 = 0 THEN l_linenumber % 3 ELSE l_linenumber END"

# Two sources with the keys every derived table shares; {rows} is orders or lineitem.
_SOURCE = f"(SELECT *, {_PART} AS part_id, p AS payload_id, {_INDEX} AS idx, {_BLOCK} AS blk FROM (SELECT *, {_PAYLOAD} AS p FROM ({{rows}}) s0) s1) s2"
_ORDERS = _SOURCE.format(rows="SELECT *, o_orderkey AS k FROM orders")
_LINES = _SOURCE.format(
    rows="SELECT *, CASE WHEN l_suppkey % 50 = 7 THEN l_orderkey + 40000000 ELSE l_orderkey END AS k, "
    "l_suppkey % 6 AS m, CAST(l_quantity AS INTEGER) AS q FROM lineitem")
_LABEL = "CASE m WHEN 0 THEN 'legacy' WHEN 1 THEN 'eip2930' WHEN 2 THEN 'eip1559' WHEN 3 THEN 'eip7702' WHEN 4 THEN 'deposit' ELSE 'odd' END"
_CODE = "CASE m WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 2 WHEN 3 THEN 4 WHEN 4 THEN 126 ELSE 3 END"
_BASE = "CASE WHEN idx = 0 AND k % 41 <> {n} OR idx > 0 AND k % 43 = {n} THEN k END"

DERIVED = {
    BLOCKS: f"""
SELECT part_id, payload_id, idx AS index, CAST(round(o_totalprice) AS BIGINT) % 100003 AS content_hash,
       CASE WHEN k % 11 <> 0 THEN k END AS received_time_a, CASE WHEN k % 3 = 0 THEN k END AS received_time_b,
       CASE WHEN k % 5 = 0 THEN k END AS received_time_c, blk AS metadata_block_number,
       {_BASE.format(n=0)} AS parent_beacon_block_root, {_BASE.format(n=1)} AS parent_hash, {_BASE.format(n=2)} AS fee_recipient,
       {_BASE.format(n=3)} AS prev_randao, CASE WHEN idx = 0 THEN blk + CASE WHEN k % 59 = 0 THEN 1 ELSE 0 END END AS base_block_number,
       {_BASE.format(n=4)} AS gas_limit,
       CASE WHEN idx = 0 THEN {{ts}} END AS block_timestamp,
       {_BASE.format(n=5)} AS extra_data, {_BASE.format(n=6)} AS base_fee_per_gas,
       k % 8 AS transaction_count, CASE WHEN k % 13 = 0 THEN k % 8 + 1 ELSE k % 8 END AS receipt_count,
       k % 3 AS withdrawal_count, k % 5 AS balance_change_count
FROM {_ORDERS} WHERE p % 7 <> 3 OR idx > 0""",
    TRANSACTIONS: f"""
SELECT part_id, payload_id, idx AS index, l_linenumber - 1 AS transaction_ordinal,
       blk + CASE WHEN l_partkey % 37 = 0 THEN 1 ELSE 0 END AS block_number, {_HASH} AS transaction_hash,
       {_CODE} AS transaction_type, CASE WHEN q = 50 THEN 'legacy' ELSE {_LABEL} END AS transaction_type_label,
       CASE WHEN l_linenumber <> 3 THEN 1 END AS to_address, (l_linenumber = 3 AND q <> 9) AS is_contract_creation,
       CASE WHEN m IN (0, 1) OR q = 8 THEN 1 END AS gas_price, CASE WHEN m IN (2, 3) THEN 1 END AS max_fee_per_gas,
       CASE WHEN m IN (2, 3) THEN 1 END AS max_priority_fee_per_gas, CASE WHEN m IN (1, 2, 3) THEN 1 END AS chain_id,
       CASE WHEN m <> 4 THEN 1 END AS nonce, CASE WHEN m <> 4 THEN 1 END AS signature_y_parity,
       CASE WHEN m <> 4 THEN 1 END AS signature_r, CASE WHEN m <> 4 AND q <> 12 THEN 1 END AS signature_s,
       CASE WHEN m = 4 THEN 1 END AS deposit_source_hash, CASE WHEN m = 4 OR q = 13 THEN 1 END AS deposit_mint,
       CASE WHEN m = 4 THEN 1 END AS deposit_is_system_transaction,
       substring('abcdefghij', 1, q % 8) AS input, q % 8 + CASE WHEN q = 21 THEN 1 ELSE 0 END AS input_length,
       CASE WHEN q = 22 THEN 'zzzz' WHEN q = 30 THEN NULL WHEN q % 8 >= 4 OR q = 17 THEN 'abcd' END AS input_selector
FROM {_LINES}""",
    RECEIPTS: f"""
SELECT part_id, payload_id, idx AS index, blk + CASE WHEN l_partkey % 31 = 0 THEN 1 ELSE 0 END AS block_number,
       {_HASH} AS transaction_hash, {_CODE} AS receipt_type, CASE WHEN q = 41 THEN 'deposit' ELSE {_LABEL} END AS receipt_type_label,
       CASE WHEN q = 1 THEN 'other' WHEN q % 2 = 0 THEN 'eip658' ELSE 'post_state_root' END AS status_kind,
       CASE WHEN q % 2 = 0 OR q = 3 THEN 1 END AS status, CASE WHEN q % 2 = 1 OR q = 4 THEN 1 END AS post_state_root,
       1000000 + l_linenumber * 100000 - CASE WHEN l_partkey % 5 = 0 THEN 300000 ELSE 0 END AS cumulative_gas_used,
       CASE WHEN m = 4 THEN 1 END AS deposit_nonce, CASE WHEN m = 4 AND q <> 14 THEN 1 END AS deposit_receipt_version,
       l_linenumber % 4 AS log_count
FROM {_LINES} WHERE NOT (l_returnflag = 'A' AND l_linenumber = 2)""",
    LOGS: f"""
SELECT part_id, payload_id, idx AS index, blk + CASE WHEN l_partkey % 29 = 0 THEN 1 ELSE 0 END AS block_number,
       {_HASH} AS transaction_hash, CAST(floor(l_linenumber / 3) AS INTEGER) AS log_ordinal, l_linenumber % 6 AS topic_count,
       CASE WHEN l_linenumber % 6 >= 1 THEN 1 END AS topic_0, CASE WHEN l_linenumber % 6 >= 2 AND q <> 11 THEN 1 END AS topic_1,
       CASE WHEN l_linenumber % 6 >= 3 THEN 1 END AS topic_2, CASE WHEN l_linenumber % 6 >= 4 OR q = 19 THEN 1 END AS topic_3
FROM {_LINES}""",
    ACCESS: f"""
SELECT part_id, payload_id, idx AS index, l_linenumber - 1 + CASE WHEN q = 2 THEN 50 ELSE 0 END AS transaction_ordinal,
       l_suppkey % 3 AS access_list_ordinal, 1 AS address, CASE WHEN l_partkey % 4 <> 0 THEN l_partkey % 3 END AS storage_key_ordinal,
       CASE WHEN l_partkey % 4 <> 0 OR q = 3 THEN 1 END AS storage_key
FROM {_LINES} WHERE m IN (1, 2, 3, 5)""",
    AUTHORIZATIONS: f"""
SELECT part_id, payload_id, idx AS index, l_linenumber - 1 + CASE WHEN q = 6 THEN 50 ELSE 0 END AS transaction_ordinal,
       l_partkey % 2 AS authorization_ordinal, l_partkey % 3 AS y_parity
FROM {_LINES} WHERE m IN (2, 3)""",
    BALANCES: f"""
SELECT part_id, payload_id, idx AS index, blk + CASE WHEN l_partkey % 23 = 0 THEN 1 ELSE 0 END AS block_number, l_suppkey % 20 AS address
FROM {_LINES}""",
    WITHDRAWALS: f"""
SELECT part_id, payload_id, idx AS index, blk + CASE WHEN l_partkey % 19 = 0 THEN 1 ELSE 0 END AS block_number,
       l_linenumber - 1 + CASE WHEN q = 1 THEN 1 ELSE 0 END AS withdrawal_ordinal
FROM {_LINES} WHERE l_linenumber <= 2""",
}
# Block time: start of the partition hour, one hour late for some orders.
_SECONDS = "(18262 + p % 30) * 86400 + (p % 3) * 3600 + CASE WHEN k % 61 = 0 THEN 3600 WHEN k % 67 = 0 THEN 86400 ELSE 0 END"
_SHORT = {BLOCKS: "f", TRANSACTIONS: "t", RECEIPTS: "r", LOGS: "l", ACCESS: "a", AUTHORIZATIONS: "u", BALANCES: "b", WITHDRAWALS: "w"}
_CTES = "WITH " + ",\n".join(
    f"{_SHORT[name]} AS ({text.replace('{ts}', f'epoch_ms(({_SECONDS}) * 1000)').replace('AS index', 'AS ix')})" for name, text in DERIVED.items())


def derived_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The eight tables as the lake reader would return them."""
    sources = {name: table(spark, sf_dir, name) for name in ("orders", "lineitem")}
    tables = {}
    for name, text in DERIVED.items():
        frame = spark.sql(text.replace("{ts}", f"timestamp_seconds({_SECONDS})").replace("FROM orders", "FROM {orders}").replace("FROM lineitem", "FROM {lineitem}"), **sources)
        binary = ("input", "input_selector")
        tables[name] = frame.select(*[
            ordered_long(F.col(c).cast("decimal(20,0)")).alias(c) if c in rulepack.ORDERED_COLUMNS
            else F.col(c).cast("binary").alias(c) if c in binary else F.col(c)
            for c in frame.columns
        ])
    return tables


def _partitions(tables: dict[str, DataFrame]) -> DataFrame:
    return tables[BLOCKS].select("part_id").distinct()


# --- the rules, spelled out --------------------------------------------------------------------


def _per_part(rule: str, dataset: str | None, rows: str, count: str = "count(*)") -> str:
    """Findings of one rule; ``rows`` is a FROM clause with a part_id column."""
    name = f"'{dataset}'" if dataset else "NULL"
    return f"SELECT '{rule}' AS rule_id, part_id, {name} AS dataset, CAST({count} AS BIGINT) AS count FROM {rows} GROUP BY part_id"


def _dup(rule: str, dataset: str, columns: str, counted: str = "payload_id") -> str:
    s = _SHORT[dataset]
    return _per_part(rule, dataset, f"(SELECT part_id FROM {s} GROUP BY part_id, {columns} HAVING count({counted}) > 1)")


def _orphan(rule: str, child: str, parent: str, columns: str) -> str:
    c, p = _SHORT[child], _SHORT[parent]
    on = f"(part_id, {columns})"
    return _per_part(rule, child, f"(SELECT DISTINCT part_id, {columns} FROM {c} WHERE {on} NOT IN (SELECT {on} FROM {p}))")


def _joined(rule: str, dataset: str | None, left: str, right: str, columns: str, where: str) -> str:
    return _per_part(rule, dataset, f"(SELECT part_id FROM {_SHORT[left]} x JOIN {_SHORT[right]} y USING (part_id, {columns}) WHERE {where})")


def _counts(rule: str, child: str, parent: str, columns: str, declared: str) -> str:
    c, p = _SHORT[child], _SHORT[parent]
    return _per_part(rule, child, f"(SELECT x.part_id FROM {p} x LEFT JOIN (SELECT part_id, {columns}, count(*) AS n FROM {c} GROUP BY ALL) y "
                                  f"USING (part_id, {columns}) WHERE {declared} <> coalesce(n, 0))")


def _ordinals(rule: str, child: str, parent: str, columns: str, declared: str, ordinal: str) -> str:
    c, p = _SHORT[child], _SHORT[parent]
    return _per_part(rule, child, f"(SELECT x.part_id FROM {p} x LEFT JOIN (SELECT part_id, {columns}, min({ordinal}) AS lo, max({ordinal}) AS hi FROM {c} "
                                  f"GROUP BY ALL) y USING (part_id, {columns}) WHERE {declared} > 0 AND (lo <> 0 OR hi <> {declared} - 1))")


def _groups(rule: str, dataset: str, columns: str, having: str, where: str = "TRUE") -> str:
    return _per_part(rule, dataset, f"(SELECT part_id FROM {_SHORT[dataset]} WHERE {where} GROUP BY part_id, {columns} HAVING {having})")


def _rows(rule: str, dataset: str, where: str) -> str:
    return _per_part(rule, dataset, f"(SELECT part_id FROM {_SHORT[dataset]} WHERE {where})")


_KEY, _TX, _HK = "payload_id, ix", "payload_id, ix, transaction_ordinal", "payload_id, ix, transaction_hash"
_BLOCK_CHILDREN = (TRANSACTIONS, RECEIPTS, LOGS, BALANCES, WITHDRAWALS)
_INTEGRITY = [
    _dup("duplicate_flashblock_key", BLOCKS, _KEY),
    _groups("payload_maps_to_multiple_blocks", BLOCKS, "payload_id", "count(DISTINCT metadata_block_number) > 1"),
    _groups("block_maps_to_multiple_payloads", BLOCKS, "metadata_block_number", "count(DISTINCT payload_id) > 1"),
    _dup("duplicate_content_hash", BLOCKS, "content_hash", "content_hash"),
    _groups("non_contiguous_payload_indexes", BLOCKS, "payload_id", "max(ix) + 1 - min(ix) <> count(ix)"),
    _groups("payload_starts_after_zero", BLOCKS, "payload_id", "min(ix) > 0"),
    "SELECT 'tail_only_payload_count', part_id, 'flashblocks', count(*) FILTER (WHERE lo > 0) FROM (SELECT part_id, min(ix) AS lo FROM f GROUP BY part_id, payload_id) GROUP BY part_id",
    *[_orphan("orphan_child_flashblock", c, BLOCKS, _KEY) for c in _BLOCK_CHILDREN],
    *[_joined("child_block_number_mismatch", c, c, BLOCKS, _KEY, "block_number <> metadata_block_number") for c in _BLOCK_CHILDREN],
    _counts("flashblock_count_mismatch", TRANSACTIONS, BLOCKS, _KEY, "transaction_count"),
    _counts("flashblock_count_mismatch", RECEIPTS, BLOCKS, _KEY, "receipt_count"),
    _counts("flashblock_count_mismatch", WITHDRAWALS, BLOCKS, _KEY, "withdrawal_count"),
    _counts("flashblock_count_mismatch", BALANCES, BLOCKS, _KEY, "balance_change_count"),
    _dup("duplicate_transaction_ordinal", TRANSACTIONS, _TX),
    _dup("duplicate_transaction_hash", TRANSACTIONS, _HK),
    _ordinals("non_contiguous_transaction_ordinals", TRANSACTIONS, BLOCKS, _KEY, "transaction_count", "transaction_ordinal"),
    _dup("duplicate_receipt_key", RECEIPTS, _HK),
    _per_part("transaction_receipt_hash_mismatch", None,
              f"(SELECT part_id FROM (SELECT DISTINCT part_id, {_HK}, 1 AS x FROM t) FULL JOIN (SELECT DISTINCT part_id, {_HK}, 1 AS y FROM r) "
              f"USING (part_id, {_HK}) WHERE x IS NULL OR y IS NULL)"),
    _joined("transaction_receipt_type_mismatch", None, TRANSACTIONS, RECEIPTS, _HK, "transaction_type_label <> receipt_type_label"),
    _dup("duplicate_receipt_log_key", LOGS, f"{_HK}, log_ordinal"),
    _counts("receipt_log_count_mismatch", LOGS, RECEIPTS, _HK, "log_count"),
    _ordinals("non_contiguous_log_ordinals", LOGS, RECEIPTS, _HK, "log_count", "log_ordinal"),
    _dup("duplicate_balance_change_key", BALANCES, f"{_KEY}, address"),
    _dup("duplicate_withdrawal_ordinal", WITHDRAWALS, f"{_KEY}, withdrawal_ordinal"),
    _ordinals("non_contiguous_withdrawal_ordinals", WITHDRAWALS, BLOCKS, _KEY, "withdrawal_count", "withdrawal_ordinal"),
    _per_part("receipt_cumulative_gas_used_not_monotonic", RECEIPTS, """(
SELECT DISTINCT part_id, payload_id, ix FROM (
  SELECT part_id, payload_id, ix, cumulative_gas_used AS v, lag(cumulative_gas_used) OVER (PARTITION BY part_id, payload_id, ix ORDER BY transaction_ordinal, cumulative_gas_used) AS before
  FROM t JOIN r USING (part_id, payload_id, ix, transaction_hash)) WHERE v < before)"""),
]
_NULLS = "(({0}) IS NULL)::INT"
_BASE_NAMES = ("parent_beacon_block_root", "parent_hash", "fee_recipient", "prev_randao", "base_block_number", "gas_limit", "block_timestamp", "extra_data", "base_fee_per_gas")
_MISSING = " + ".join(_NULLS.format(c) for c in _BASE_NAMES)
_SET = {c: f"{c} IS NOT NULL" for c in ("gas_price", "max_fee_per_gas", "max_priority_fee_per_gas", "chain_id", "nonce")}
_SIGNED = "(signature_y_parity IS NOT NULL AND signature_r IS NOT NULL AND signature_s IS NOT NULL)"
_UNSIGNED = "(signature_y_parity IS NULL AND signature_r IS NULL AND signature_s IS NULL)"
_DEPOSIT = "(deposit_source_hash IS NOT NULL AND deposit_mint IS NOT NULL AND deposit_is_system_transaction IS NOT NULL)"
_NO_DEPOSIT = "(deposit_source_hash IS NULL AND deposit_mint IS NULL AND deposit_is_system_transaction IS NULL)"
_NO_FEES = "max_fee_per_gas IS NULL AND max_priority_fee_per_gas IS NULL"
_FEES = "max_fee_per_gas IS NOT NULL AND max_priority_fee_per_gas IS NOT NULL"
_SHAPE = f"""CASE transaction_type_label
  WHEN 'legacy' THEN gas_price IS NOT NULL AND nonce IS NOT NULL AND {_SIGNED} AND {_NO_FEES} AND {_NO_DEPOSIT}
  WHEN 'eip2930' THEN gas_price IS NOT NULL AND chain_id IS NOT NULL AND nonce IS NOT NULL AND {_SIGNED} AND {_NO_FEES} AND {_NO_DEPOSIT}
  WHEN 'eip1559' THEN gas_price IS NULL AND {_FEES} AND chain_id IS NOT NULL AND nonce IS NOT NULL AND {_SIGNED} AND {_NO_DEPOSIT}
  WHEN 'eip7702' THEN gas_price IS NULL AND {_FEES} AND chain_id IS NOT NULL AND nonce IS NOT NULL AND {_SIGNED} AND {_NO_DEPOSIT}
  WHEN 'deposit' THEN gas_price IS NULL AND {_NO_FEES} AND chain_id IS NULL AND nonce IS NULL AND {_UNSIGNED} AND {_DEPOSIT}
  ELSE FALSE END"""
_EXPECTED = "CASE {0} WHEN 0 THEN 'legacy' WHEN 1 THEN 'eip2930' WHEN 2 THEN 'eip1559' WHEN 4 THEN 'eip7702' WHEN 126 THEN 'deposit' END"
_TIME = "make_timestamp(CAST(floor(part_id / 32) AS BIGINT) * 86400000000)"
_FIELDS = [
    *[f"SELECT 'received_time_slot_coverage', part_id, 'flashblocks', count({c}) FROM f GROUP BY part_id" for c in ("received_time_a", "received_time_b", "received_time_c")],
    _rows("all_received_time_slots_missing", BLOCKS, "received_time_a IS NULL AND received_time_b IS NULL AND received_time_c IS NULL"),
    _rows("partition_date_mismatch", BLOCKS, "ix = 0 AND (CAST(block_timestamp AS DATE) <> CAST(" + _TIME + " AS DATE) OR hour(block_timestamp) <> part_id % 32 - 1)"),
    _per_part("base_fields_missing_on_index_zero", BLOCKS, "f WHERE ix = 0", f"sum({_MISSING})"),
    _per_part("base_fields_present_on_nonzero_index", BLOCKS, "f WHERE ix > 0", f"sum(9 - ({_MISSING}))"),
    _rows("base_block_number_mismatch", BLOCKS, "ix = 0 AND base_block_number <> metadata_block_number"),
    "SELECT 'flashblock_transaction_receipt_count_mismatch', part_id, 'flashblocks', NULL FROM f WHERE transaction_count <> receipt_count GROUP BY part_id",
    _rows("transaction_type_mismatch", TRANSACTIONS, _EXPECTED.format("transaction_type") + " IS DISTINCT FROM transaction_type_label"),
    _rows("transaction_optional_field_shape_mismatch", TRANSACTIONS, f"NOT ({_SHAPE})"),
    _rows("contract_creation_flag_mismatch", TRANSACTIONS, "(to_address IS NULL) <> is_contract_creation"),
    _rows("transaction_input_length_mismatch", TRANSACTIONS, "input_length <> length(input)"),
    _rows("transaction_input_selector_mismatch", TRANSACTIONS,
          "CASE WHEN input_length < 4 THEN input_selector IS NOT NULL ELSE input_selector IS DISTINCT FROM substring(input, 1, 4) END"),
    _rows("receipt_type_mismatch", RECEIPTS, _EXPECTED.format("receipt_type") + " IS DISTINCT FROM receipt_type_label"),
    _rows("receipt_status_shape_mismatch", RECEIPTS, "NOT CASE status_kind WHEN 'eip658' THEN status IS NOT NULL AND post_state_root IS NULL "
          "WHEN 'post_state_root' THEN status IS NULL AND post_state_root IS NOT NULL ELSE FALSE END"),
    _rows("deposit_receipt_field_mismatch", RECEIPTS, "(deposit_nonce IS NOT NULL)::INT + (deposit_receipt_version IS NOT NULL)::INT <> CASE WHEN receipt_type_label = 'deposit' THEN 2 ELSE 0 END"),
    _rows("topic_count_out_of_range", LOGS, "topic_count > 4"),
    _rows("topic_count_shape_mismatch", LOGS, " OR ".join(f"(topic_count >= {i + 1}) <> (topic_{i} IS NOT NULL)" for i in range(4))),
    _orphan("orphan_access_list_row", ACCESS, TRANSACTIONS, _TX),
    _dup("duplicate_access_list_key", ACCESS, f"{_TX}, access_list_ordinal, storage_key_ordinal", "address"),
    _groups("access_list_storage_key_shape_mismatch", ACCESS, f"{_TX}, access_list_ordinal",
            "NOT ((count(storage_key_ordinal) = 0 AND count(*) = 1 AND count(storage_key) = 0) OR (count(storage_key_ordinal) = count(*) AND count(storage_key) = count(*)))"),
    _groups("non_contiguous_access_list_ordinals", ACCESS, _TX, "min(access_list_ordinal) <> 0 OR max(access_list_ordinal) <> count(DISTINCT access_list_ordinal) - 1"),
    _groups("non_contiguous_access_storage_key_ordinals", ACCESS, f"{_TX}, access_list_ordinal",
            "list_sort(list(storage_key_ordinal)) <> range(count(*))", "storage_key_ordinal IS NOT NULL"),
    _orphan("orphan_authorization_row", AUTHORIZATIONS, TRANSACTIONS, _TX),
    _dup("duplicate_authorization_key", AUTHORIZATIONS, f"{_TX}, authorization_ordinal", "y_parity"),
    _joined("authorization_non_7702", AUTHORIZATIONS, AUTHORIZATIONS, TRANSACTIONS, _TX, "transaction_type_label <> 'eip7702'"),
    _rows("authorization_y_parity_out_of_range", AUTHORIZATIONS, "y_parity > 1"),
    _groups("non_contiguous_authorization_ordinals", AUTHORIZATIONS, _TX, "list_sort(list(authorization_ordinal)) <> range(count(*))"),
]
_METRICS = "('tail_only_payload_count', 'received_time_slot_coverage')"


def _findings_sql(parts: list[str]) -> str:
    rows = "\nUNION ALL ".join(parts)
    return f"{_CTES}\nSELECT rule_id, part_id, dataset, coalesce(count, -1) AS count FROM (\n{rows}\n) found(rule_id, part_id, dataset, count) WHERE count > 0 OR count IS NULL OR rule_id IN {_METRICS}"


_RELATION_RULES = _findings_sql(_INTEGRITY)
_FIELD_RULES = _findings_sql(_FIELDS)


def _short(rows: DataFrame) -> DataFrame:
    return rows.select("rule_id", "part_id", "dataset", F.coalesce("count", F.lit(-1)).alias("count"))


@query("rulepack_integrity", _RELATION_RULES)
def rulepack_integrity(spark, sf_dir):
    """Keys, orphans, counts, ordinals and order: 25 rules. The findings of each step, a few rows a partition and rule, are
    computed before the next begins, so the disk holds the shuffles of one step at a time."""
    t = derived_tables(spark, sf_dir)
    steps = [
        rulepack.transaction_children(t).where("rule_id = 'duplicate_transaction_ordinal'"),
        rulepack.flashblock_children(t), rulepack.receipt_relations(t),
        rulepack.receipt_logs(t).unionByName(rulepack.repeated_keys(t)),  # they share the cells of logs
        rulepack.payload_rules(t, _partitions(t)), rulepack.gas_order(t),
    ]
    return _short(reduce(DataFrame.unionByName, [settle(step) for step in steps]))


@query("rulepack_fields", _FIELD_RULES)
def rulepack_fields(spark, sf_dir):
    """Field contracts, access lists and authorizations: 25 rules in one plan."""
    t = derived_tables(spark, sf_dir)
    rows = rulepack.transaction_children(t).where("rule_id <> 'duplicate_transaction_ordinal'")
    for frame in (
        rulepack.flashblock_rows(t, _partitions(t)), rulepack.transaction_rows(t), rulepack.receipt_rows(t), rulepack.log_rows(t),
        rulepack.authorization_rows(t), rulepack.access_list_items(t), rulepack.authorization_items(t),
    ):
        rows = rows.unionByName(frame)
    return _short(rows)


_LENGTHS = "SELECT part_id, 'payload_length' AS measure, max(ix) - min(ix) + 1 AS v FROM f GROUP BY part_id, payload_id"
_MEASURES = f"""m AS ({_LENGTHS}
  UNION ALL SELECT part_id, 'transaction_count', transaction_count FROM f UNION ALL SELECT part_id, 'balance_change_count', balance_change_count FROM f
  UNION ALL SELECT part_id, 'withdrawal_count', withdrawal_count FROM f UNION ALL SELECT part_id, 'log_count', log_count FROM r)"""


@query("rulepack_distributions", f"""{_CTES}, {_MEASURES}
SELECT part_id, measure, count(v) AS count, CAST(min(v) AS BIGINT) AS minimum, median(v) AS median_value, CAST(max(v) AS BIGINT) AS maximum FROM m GROUP BY ALL
""")
def rulepack_distributions(spark, sf_dir):
    summary = baseline.measure_summary(baseline.measure_histogram(derived_tables(spark, sf_dir)))
    return summary.withColumn("minimum", F.col("minimum").cast("bigint")).withColumn("maximum", F.col("maximum").cast("bigint"))


@query("rulepack_snapshot", f"""{_CTES}, p AS (SELECT part_id, payload_id, min(ix) AS lo, max(ix) - min(ix) + 1 AS v FROM f GROUP BY ALL),
s AS (SELECT part_id, count(*) AS n, median(v) AS med, greatest(1, floor(median(v) / 2)) AS thr, count(*) FILTER (WHERE lo > 0) AS tail_only FROM p GROUP BY ALL),
c AS (SELECT part_id, n, med, tail_only, count(*) FILTER (WHERE v <= thr) AS short FROM p JOIN s USING (part_id) GROUP BY ALL),
x AS (SELECT part_id, count(*) AS total_transactions, count(*) FILTER (WHERE transaction_type_label = 'legacy') AS legacy_count FROM t GROUP BY ALL)
SELECT part_id, CAST(date '1970-01-01' + CAST(floor(part_id / 32) AS INTEGER) AS DATE) AS partition_date, CAST(part_id % 32 - 1 AS INTEGER) AS partition_hour, n AS payload_length_count, tail_only,
       CASE WHEN n >= 4 AND med >= 3 AND short > 0 AND short < n THEN short ELSE 0 END AS short_runs,
       tail_only >= 3 AND tail_only / n >= 0.25 AS tail_only_excess, total_transactions, legacy_count
FROM c JOIN x USING (part_id)
""")
def rulepack_snapshot(spark, sf_dir):
    t = derived_tables(spark, sf_dir)
    hist, mix = materialize(baseline.measure_histogram(t)), materialize(baseline.mix_snapshot(t))
    files = spark.createDataFrame([], "part_id int, dataset string, row_count bigint")
    rows = baseline.partition_snapshot(t, _partitions(t), files, hist, baseline.measure_summary(hist), mix)
    return rows.select(
        "part_id", part_date("part_id").alias("partition_date"), part_hour("part_id").alias("partition_hour"), "payload_length_count",
        "tail_only", F.coalesce("short_runs", F.lit(0)).alias("short_runs"), "tail_only_excess", "total_transactions", "legacy_count")
