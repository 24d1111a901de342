"""The rule pack: every table rule as an instance of a generic operator, over all partitions at once.

``part_id`` is the scope of each check. Rules on the same key share one grouping, rules on rows of a
table share one scan. Ordinals, counts and block numbers arrive as order-preserving longs, whose
zero is ``U64_ZERO``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import presence
from ..functions.columns import U64_ZERO
from ..functions.scope import part_date, part_hour
from ..operators import digest, keys, ordered, relations
from ..operators.findings import as_findings, example_json
from ..operators.relations import Relation
from ..operators.tally import tally
from .datasets import FIRST_ROW_COLUMNS, RECEIVED_SLOTS, STATUS_CONTRACT, TYPE_CONTRACT, TYPE_LABELS

SCOPE = ("part_id",)
KEY = ("payload_id", "index")
TX_KEY = (*KEY, "transaction_ordinal")
HASH_KEY = (*KEY, "transaction_hash")

BLOCKS = "flashblocks"
WITHDRAWALS = "flashblock_withdrawals"
TRANSACTIONS = "flashblock_transactions"
ACCESS = "flashblock_transaction_access_list"
AUTHORIZATIONS = "flashblock_transaction_authorizations"
RECEIPTS = "flashblock_receipts"
LOGS = "flashblock_receipt_logs"
BALANCES = "flashblock_balance_changes"

# Columns read as order-preserving longs.
ORDERED_COLUMNS = (
    "index",
    "metadata_block_number",
    "base_block_number",
    "block_number",
    "transaction_count",
    "withdrawal_count",
    "balance_change_count",
    "receipt_count",
    "log_count",
    "transaction_ordinal",
    "withdrawal_ordinal",
    "access_list_ordinal",
    "storage_key_ordinal",
    "authorization_ordinal",
    "log_ordinal",
    "cumulative_gas_used",
)

Tables = Mapping[str, DataFrame]


def _emit(rows: DataFrame, entries: Sequence[tuple], partitions: DataFrame | None = None) -> DataFrame:
    """Findings from a per-partition summary.

    An entry ``(rule, dataset, count)`` becomes a finding where its count is above zero. With
    ``partitions``, entries ``(rule, dataset, count, example)`` are metrics: one finding per
    partition whatever the count, also for partitions the summary has no row for.
    """

    def struct(rule: str, dataset: str | None, count: Column, *metric: Column | None) -> Column:
        value = F.coalesce(count, F.lit(0)) if metric else count
        example = metric[0] if metric and metric[0] is not None else F.lit(None)
        return F.struct(
            F.lit(rule).alias("rule_id"),
            F.lit(dataset).cast("string").alias("dataset"),
            value.cast("bigint").alias("count"),
            example.cast("string").alias("example"),
            F.lit(bool(metric)).alias("metric"),
        )

    if partitions is not None:
        rows = partitions.join(rows, "part_id", "left")
    found = rows.select("part_id", F.inline(F.array(*[struct(*entry) for entry in entries])))
    found = found.where(F.col("metric") | (F.col("count") > 0))
    return as_findings(found, F.col("rule_id"), F.col("dataset"), "count", example=F.col("example"))


def _of(relation: str, column: str) -> Column:
    return F.when(F.col("relation") == relation, F.col(column))


def _cells(table: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per logical key. Both the repeated-key and the count rule of a table start here, so Spark
    scans and shuffles the two largest tables once for both (the second use is a reused exchange)."""
    return table.groupBy(*SCOPE, *columns).agg(F.count(F.lit(1)).alias("rows"))


def log_cells(t: Tables) -> DataFrame:
    return _cells(t[LOGS], (*HASH_KEY, "log_ordinal"))


def balance_cells(t: Tables) -> DataFrame:
    return _cells(t[BALANCES], (*KEY, "address"))


def flashblock_children(t: Tables) -> DataFrame:
    """Every child against its flashblock, each read once: orphans, block numbers, repeated flashblock keys, declared child
    counts and ordinal ranges."""
    zero = {"attribute": "block_number", "zero": U64_ZERO, "base": U64_ZERO}
    children = [
        Relation(TRANSACTIONS, t[TRANSACTIONS], KEY, declared="transaction_count", counted="transaction_ordinal",
                 ordinal="transaction_ordinal", **zero),
        Relation(RECEIPTS, t[RECEIPTS], KEY, declared="receipt_count", counted="transaction_hash", **zero),
        Relation(LOGS, t[LOGS], KEY, attribute="block_number"),
        Relation(BALANCES, t[BALANCES], KEY, declared="balance_change_count", **zero),
        Relation(WITHDRAWALS, t[WITHDRAWALS], KEY, declared="withdrawal_count", counted="withdrawal_ordinal",
                 ordinal="withdrawal_ordinal", **zero),
    ]
    parent = Relation(BLOCKS, t[BLOCKS], KEY, attribute="metadata_block_number")
    rows = relations.key_contract(parent, children, SCOPE)
    entries = [("duplicate_flashblock_key", BLOCKS, _of(TRANSACTIONS, "duplicate_parent_keys"))]
    for child in children:
        entries.append(("orphan_child_flashblock", child.name, _of(child.name, "orphan_keys")))
        entries.append(("child_block_number_mismatch", child.name, _of(child.name, "mismatched_rows")))
        if child.declared:
            entries.append(("flashblock_count_mismatch", child.name, _of(child.name, "count_mismatches")))
    entries.append(("non_contiguous_transaction_ordinals", TRANSACTIONS, _of(TRANSACTIONS, "ordinal_mismatches")))
    entries.append(("non_contiguous_withdrawal_ordinals", WITHDRAWALS, _of(WITHDRAWALS, "ordinal_mismatches")))
    return _emit(rows, entries)


def receipt_relations(t: Tables) -> DataFrame:
    """Transactions against receipts by hash: repeated hashes, set difference, label agreement."""
    parent = Relation(TRANSACTIONS, t[TRANSACTIONS], HASH_KEY, attribute="transaction_type_label")
    child = Relation(RECEIPTS, t[RECEIPTS], HASH_KEY, attribute="receipt_type_label")
    rows = relations.key_agreement(parent, [child], SCOPE)
    return _emit(rows, [
        ("duplicate_transaction_hash", TRANSACTIONS, F.col("duplicate_parent_keys")),
        ("duplicate_receipt_key", RECEIPTS, F.col("duplicate_child_keys")),
        ("transaction_receipt_hash_mismatch", None, F.col("orphan_keys") + F.col("childless_keys")),
        ("transaction_receipt_type_mismatch", None, F.col("mismatched_rows")),
    ])


def receipt_logs(t: Tables) -> DataFrame:
    """Declared log counts and log ordinal ranges of receipts."""
    logs = Relation(LOGS, log_cells(t), HASH_KEY, declared="log_count", ordinal="log_ordinal", weight="rows",
                    zero=U64_ZERO, base=U64_ZERO)
    rows = relations.declared_counts(Relation(RECEIPTS, t[RECEIPTS], HASH_KEY), [logs], SCOPE)
    return _emit(rows, [
        ("receipt_log_count_mismatch", LOGS, F.col("count_mismatches")),
        ("non_contiguous_log_ordinals", LOGS, F.col("ordinal_mismatches")),
    ])


def transaction_children(t: Tables) -> DataFrame:
    """Access lists and authorizations against transactions by ordinal, and repeated transaction ordinals."""
    parent = Relation(TRANSACTIONS, t[TRANSACTIONS], TX_KEY, flag=F.col("transaction_type_label") != "eip7702")
    children = [Relation(ACCESS, t[ACCESS], TX_KEY), Relation(AUTHORIZATIONS, t[AUTHORIZATIONS], TX_KEY)]
    rows = relations.key_agreement(parent, children, SCOPE)
    return _emit(rows, [
        ("duplicate_transaction_ordinal", TRANSACTIONS, _of(ACCESS, "duplicate_parent_keys")),
        ("orphan_access_list_row", ACCESS, _of(ACCESS, "orphan_keys")),
        ("orphan_authorization_row", AUTHORIZATIONS, _of(AUTHORIZATIONS, "orphan_keys")),
        ("authorization_non_7702", AUTHORIZATIONS, _of(AUTHORIZATIONS, "flagged_rows")),
    ])


def repeated_keys(t: Tables) -> DataFrame:
    """Logical keys no other check groups by. The gate guarantees that they hold no NULL."""
    specs = [
        ("duplicate_content_hash", BLOCKS, _cells(t[BLOCKS], ("content_hash",))),
        ("duplicate_receipt_log_key", LOGS, log_cells(t)),
        ("duplicate_balance_change_key", BALANCES, balance_cells(t)),
        ("duplicate_withdrawal_ordinal", WITHDRAWALS, _cells(t[WITHDRAWALS], (*KEY, "withdrawal_ordinal"))),
    ]
    frames = [
        _emit(tally(cells, SCOPE, {"repeated": F.col("rows") > 1}), [(rule, dataset, F.col("repeated"))])
        for rule, dataset, cells in specs
    ]
    return reduce(DataFrame.unionByName, frames)


def payload_ranges(t: Tables) -> DataFrame:
    """Per payload: index range and block range."""
    return t[BLOCKS].groupBy(*SCOPE, "payload_id").agg(
        F.min("index").alias("first_ordinal"),
        F.max("index").alias("last_ordinal"),
        F.count("index").alias("ordinal_count"),
        F.min("metadata_block_number").alias("low_block"),
        F.max("metadata_block_number").alias("high_block"),
    )


def payload_rules(t: Tables, partitions: DataFrame) -> DataFrame:
    """Index gaps and late starts of payloads, payload/block dependencies, and the tail-only metric."""
    summary = tally(payload_ranges(t), SCOPE, {
        "several_blocks": F.col("low_block") != F.col("high_block"),
        "gaps": keys.has_gap(),
        "late": keys.starts_late(U64_ZERO),
    })
    several = keys.dependency_violations(t[BLOCKS], ["metadata_block_number"], "payload_id", SCOPE)
    return _emit(summary, [
        ("payload_maps_to_multiple_blocks", BLOCKS, F.col("several_blocks")),
        ("non_contiguous_payload_indexes", BLOCKS, F.col("gaps")),
        ("payload_starts_after_zero", BLOCKS, F.col("late")),
        ("tail_only_payload_count", BLOCKS, F.col("late"), None),
    ], partitions).unionByName(_emit(several, [("block_maps_to_multiple_payloads", BLOCKS, F.col("violations"))]))


def gas_order(t: Tables) -> DataFrame:
    """Cumulative gas of receipts along the ordinals of their transactions."""
    rows = ordered.backward_children(
        t[TRANSACTIONS], t[RECEIPTS], KEY, "transaction_hash", "transaction_ordinal", "cumulative_gas_used", SCOPE)
    return _emit(rows, [("receipt_cumulative_gas_used_not_monotonic", RECEIPTS, F.col("backward_groups"))])


def access_list_items(t: Tables) -> DataFrame:
    """Access-list keys, storage-key shape and both ordinal levels in one chain of shrinking groupings."""
    cells = t[ACCESS].groupBy(*SCOPE, *TX_KEY, "access_list_ordinal", "storage_key_ordinal").agg(
        F.count(F.lit(1)).alias("rows"), F.count("address").alias("addressed"), F.count("storage_key").alias("keys"))
    storage = F.col("storage_key_ordinal")
    items = cells.groupBy(*SCOPE, *TX_KEY, "access_list_ordinal").agg(
        F.sum("rows").alias("rows"),
        F.sum("keys").alias("keys"),
        F.coalesce(F.sum(F.when(storage.isNotNull(), F.col("rows"))), F.lit(0)).alias("ordinal_count"),
        F.count(storage).alias("distinct_ordinals"),
        F.min(storage).alias("first_ordinal"),
        F.max(storage).alias("last_ordinal"),
        F.count_if(F.col("addressed") > 1).alias("repeated"),
    )
    entries = items.groupBy(*SCOPE, *TX_KEY).agg(
        F.sum("repeated").alias("repeated"),
        F.count_if(~keys.nullable_ordinal_item("rows", "ordinal_count", "keys")).alias("shape"),
        F.count_if((F.col("ordinal_count") > 0) & ~keys.is_ordinal_list(U64_ZERO)).alias("storage"),
        F.min("access_list_ordinal").alias("first_ordinal"),
        F.max("access_list_ordinal").alias("last_ordinal"),
        F.count("access_list_ordinal").alias("distinct_ordinals"),
    )
    rows = entries.groupBy(*SCOPE).agg(
        F.sum("repeated").alias("repeated"),
        F.sum("shape").alias("shape"),
        F.sum("storage").alias("storage"),
        F.count_if(~keys.is_ordinal_set(U64_ZERO)).alias("entries"),
    )
    return _emit(rows, [
        ("duplicate_access_list_key", ACCESS, F.col("repeated")),
        ("access_list_storage_key_shape_mismatch", ACCESS, F.col("shape")),
        ("non_contiguous_access_storage_key_ordinals", ACCESS, F.col("storage")),
        ("non_contiguous_access_list_ordinals", ACCESS, F.col("entries")),
    ])


def authorization_items(t: Tables) -> DataFrame:
    """Authorization keys and ordinals."""
    groups = keys.ordinal_groups(t[AUTHORIZATIONS], TX_KEY, "authorization_ordinal", SCOPE, counted="y_parity")
    rows = groups.groupBy(*SCOPE).agg(
        F.sum("duplicate_keys").alias("repeated"), F.count_if(~keys.is_ordinal_list(U64_ZERO)).alias("lists"))
    return _emit(rows, [
        ("duplicate_authorization_key", AUTHORIZATIONS, F.col("repeated")),
        ("non_contiguous_authorization_ordinals", AUTHORIZATIONS, F.col("lists")),
    ])


def _row_rules(table: DataFrame, dataset: str, checks: Mapping[str, Column]) -> DataFrame:
    wide = table.groupBy(*SCOPE).agg(*[F.count_if(condition).alias(rule) for rule, condition in checks.items()])
    return _emit(wide, [(rule, dataset, F.col(rule)) for rule in checks])


def flashblock_rows(t: Tables, partitions: DataFrame) -> DataFrame:
    """All row rules of flashblocks and the arrival-time coverage, from one scan."""
    first = F.col("index") == U64_ZERO
    base_cells = presence.present_cells(FIRST_ROW_COLUMNS)
    in_partition = presence.instant_in_partition("block_timestamp", part_date("part_id"), part_hour("part_id"))
    wide = t[BLOCKS].groupBy(*SCOPE).agg(
        F.coalesce(F.sum(F.when(first, len(FIRST_ROW_COLUMNS) - base_cells)), F.lit(0)).alias("missing_cells"),
        F.coalesce(F.sum(F.when(~first, base_cells)), F.lit(0)).alias("extra_cells"),
        F.count_if(first & (F.col("base_block_number") != F.col("metadata_block_number"))).alias("base_block"),
        F.count_if(first & ~in_partition).alias("misplaced"),
        F.count_if(presence.all_missing(RECEIVED_SLOTS)).alias("unseen"),
        F.count_if(F.col("transaction_count") != F.col("receipt_count")).alias("counts_differ"),
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count(slot).alias(slot) for slot in RECEIVED_SLOTS],
    )
    total = F.coalesce("total_rows", F.lit(0))
    coverage = [
        ("received_time_slot_coverage", BLOCKS, F.col(slot),
         example_json([("slot", F.lit(slot.removeprefix("received_time_"))), ("total_rows", total)]))
        for slot in RECEIVED_SLOTS
    ]
    found = _emit(wide, [
        ("base_fields_missing_on_index_zero", BLOCKS, F.col("missing_cells")),
        ("base_fields_present_on_nonzero_index", BLOCKS, F.col("extra_cells")),
        ("base_block_number_mismatch", BLOCKS, F.col("base_block")),
        ("partition_date_mismatch", BLOCKS, F.col("misplaced")),
        ("all_received_time_slots_missing", BLOCKS, F.col("unseen")),
        ("flashblock_transaction_receipt_count_mismatch", BLOCKS, F.col("counts_differ")),
        *coverage,
    ], partitions)
    # This rule says that declared counts disagree, not on how many rows.
    uncounted = F.col("rule_id") == "flashblock_transaction_receipt_count_mismatch"
    return found.withColumn("count", F.when(~uncounted, F.col("count")))


def transaction_rows(t: Tables) -> DataFrame:
    return _row_rules(t[TRANSACTIONS], TRANSACTIONS, {
        "transaction_type_mismatch": ~presence.code_matches_label("transaction_type", "transaction_type_label", TYPE_LABELS),
        "transaction_optional_field_shape_mismatch": ~presence.label_contract("transaction_type_label", TYPE_CONTRACT),
        "contract_creation_flag_mismatch": F.col("to_address").isNull() != F.col("is_contract_creation"),
        "transaction_input_length_mismatch": F.col("input_length") != F.octet_length("input"),
        "transaction_input_selector_mismatch": ~presence.prefix_matches("input_length", "input", "input_selector", 4),
    })


def receipt_rows(t: Tables) -> DataFrame:
    deposit_cells = presence.present_cells(("deposit_nonce", "deposit_receipt_version"))
    wanted = F.when(F.col("receipt_type_label").eqNullSafe("deposit"), 2).otherwise(0)
    return _row_rules(t[RECEIPTS], RECEIPTS, {
        "receipt_type_mismatch": ~presence.code_matches_label("receipt_type", "receipt_type_label", TYPE_LABELS),
        "receipt_status_shape_mismatch": ~presence.label_contract("status_kind", STATUS_CONTRACT),
        "deposit_receipt_field_mismatch": deposit_cells != wanted,
    })


def log_rows(t: Tables) -> DataFrame:
    topics = ("topic_0", "topic_1", "topic_2", "topic_3")
    return _row_rules(t[LOGS], LOGS, {
        "topic_count_out_of_range": F.col("topic_count") > len(topics),
        "topic_count_shape_mismatch": ~presence.slots_match_count("topic_count", topics),
    })


def authorization_rows(t: Tables) -> DataFrame:
    return _row_rules(t[AUTHORIZATIONS], AUTHORIZATIONS, {"authorization_y_parity_out_of_range": F.col("y_parity") > 1})


def transaction_digests(t: Tables) -> DataFrame:
    """Keccak-256 of every encoded transaction against its hash: a separate narrow scan, on request only."""
    rows = digest.digest_mismatches(t[TRANSACTIONS], "transaction_rlp", "transaction_hash", "keccak256", SCOPE)
    return _emit(rows, [("transaction_rlp_hash_mismatch", TRANSACTIONS, F.col("mismatches"))])


def table_findings(t: Tables, partitions: DataFrame, verify_hashes: bool = False) -> DataFrame:
    """All integrity and field findings of the tables. ``partitions`` lists the ``part_id`` under audit."""
    frames = [
        flashblock_children(t),
        receipt_relations(t),
        receipt_logs(t),
        transaction_children(t),
        repeated_keys(t),
        payload_rules(t, partitions),
        gas_order(t),
        access_list_items(t),
        authorization_items(t),
        flashblock_rows(t, partitions),
        transaction_rows(t),
        receipt_rows(t),
        log_rows(t),
        authorization_rows(t),
    ]
    if verify_hashes:
        frames.append(transaction_digests(t))
    return reduce(DataFrame.unionByName, frames)
