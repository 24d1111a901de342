"""One defect per rule. All defective partitions share one lake and one audit."""

from __future__ import annotations

import json
from collections import defaultdict
from datetime import date, timedelta

import pytest

from lakeaudit.plans.audit import audit
from lakeaudit.plans.rules import RULES

from . import lakegen as g
from .lakegen import A, B, F, L, R, T, U, W

DAY = date(2026, 4, 5)
METRICS = {rule for rule, _, status, _ in RULES if status == "metric"}
PATH_RULES = {
    "partition_parse_error", "missing_required_dataset", "invalid_parquet_file", "no_matching_parquet_files",
    "multiple_readable_files_for_dataset_partition", "schema_mismatch", "mixed_storage_layout_for_partition", "unknown_dataset",
}
DRIFT_RULES = {"dataset_physical_drift", "transaction_type_mix_drift"}


def cell(dataset, column, row, value):
    def damage(tables, **_):
        tables[dataset][row][column] = value
    return damage


def several(*damages):
    def damage(tables, **kw):
        for one in damages:
            one(tables, **kw)
    return damage


def reindex(mapping):
    def damage(tables, **_):
        for rows in tables.values():
            for row in rows:
                row["index"] = mapping.get(row["index"], row["index"])
    return damage


def repeat(dataset, row):
    def damage(tables, **_):
        tables[dataset].append(dict(tables[dataset][row]))
    return damage


def copied(dataset, column, source, target):
    def damage(tables, **_):
        tables[dataset][target][column] = tables[dataset][source][column]
    return damage


def split_payload(tables, **_):
    for rows in tables.values():
        for row in rows:
            if row["index"] == 3:
                row["payload_id"] = b"otherpid"


def to_1559(tables, **_):
    for dataset, prefix in ((T, "transaction"), (R, "receipt")):
        tables[dataset][2][f"{prefix}_type"] = 2
        tables[dataset][2][f"{prefix}_type_label"] = "eip1559"


def clones(count, indexes, first_kept=None):
    """More payloads next to the first; ``indexes`` are those the clones keep."""
    def damage(tables, day, hour):
        extra = [g.only_indexes(g.payload_tables(day, hour, f"clone{i}", 200 + i), indexes) for i in range(count)]
        merged = g.merged(tables, *extra)
        if first_kept is not None:
            kept = g.only_indexes(tables, first_kept)
            merged = g.merged(kept, *extra)
        tables.update(merged)
    return damage


def childless(tables, **_):
    """A flashblock that declares withdrawals but has none."""
    tables[F][1]["withdrawal_count"] = 2


PID = b"\xff" * 8
# rule -> (damage, exact count per (rule, dataset), NULL counts included)
CASES = {
    "duplicate_flashblock_key": (reindex({3: 2}), {("duplicate_flashblock_key", F): 1}),
    "payload_maps_to_multiple_blocks": (cell(F, "metadata_block_number", 2, 7302), {("payload_maps_to_multiple_blocks", F): 1}),
    "non_contiguous_payload_indexes": (reindex({3: 5}), {("non_contiguous_payload_indexes", F): 1}),
    "orphan_child_flashblock": (cell(T, "payload_id", 3, PID), {("orphan_child_flashblock", T): 1}),
    "flashblock_count_mismatch": (cell(F, "transaction_count", 0, 4), {("flashblock_count_mismatch", T): 1}),
    "flashblock_transaction_receipt_count_mismatch": (
        cell(F, "receipt_count", 0, 5), {("flashblock_transaction_receipt_count_mismatch", F): None}),
    "child_block_number_mismatch": (cell(T, "block_number", 0, 7300), {("child_block_number_mismatch", T): 1}),
    "duplicate_transaction_ordinal": (cell(T, "transaction_ordinal", 1, 0), {("duplicate_transaction_ordinal", T): 1}),
    "duplicate_transaction_hash": (copied(T, "transaction_hash", 0, 1), {("duplicate_transaction_hash", T): 1}),
    "non_contiguous_transaction_ordinals": (cell(T, "transaction_ordinal", 5, 3), {("non_contiguous_transaction_ordinals", T): 1}),
    "duplicate_receipt_key": (copied(R, "transaction_hash", 0, 1), {("duplicate_receipt_key", R): 1}),
    "transaction_receipt_hash_mismatch": (
        cell(R, "transaction_hash", 0, b"\xee" * 32), {("transaction_receipt_hash_mismatch", None): 2}),
    "duplicate_receipt_log_key": (cell(L, "log_ordinal", 2, 0), {("duplicate_receipt_log_key", L): 1}),
    "receipt_log_count_mismatch": (cell(R, "log_count", 2, 1), {("receipt_log_count_mismatch", L): 1}),
    "non_contiguous_log_ordinals": (cell(L, "log_ordinal", 2, 2), {("non_contiguous_log_ordinals", L): 1}),
    "duplicate_balance_change_key": (repeat(B, 0), {("duplicate_balance_change_key", B): 1}),
    "duplicate_withdrawal_ordinal": (repeat(W, 0), {("duplicate_withdrawal_ordinal", W): 1}),
    "non_contiguous_withdrawal_ordinals": (cell(W, "withdrawal_ordinal", 2, 1), {("non_contiguous_withdrawal_ordinals", W): 1}),
    "transaction_type_mismatch": (cell(T, "transaction_type_label", 3, "eip1559"), {("transaction_type_mismatch", T): 1}),
    "receipt_type_mismatch": (cell(R, "receipt_type_label", 3, "eip1559"), {("receipt_type_mismatch", R): 1}),
    "transaction_receipt_type_mismatch": (
        several(cell(R, "receipt_type", 3, 1), cell(R, "receipt_type_label", 3, "eip2930")), {("transaction_receipt_type_mismatch", None): 1}),
    "transaction_optional_field_shape_mismatch": (
        cell(T, "gas_price", 2, b"\x01" * 16), {("transaction_optional_field_shape_mismatch", T): 1}),
    "contract_creation_flag_mismatch": (cell(T, "to_address", 0, None), {("contract_creation_flag_mismatch", T): 1}),
    "transaction_input_length_mismatch": (cell(T, "input_length", 0, 13), {("transaction_input_length_mismatch", T): 1}),
    "transaction_input_selector_mismatch": (cell(T, "input_selector", 2, bytes(4)), {("transaction_input_selector_mismatch", T): 1}),
    "transaction_rlp_hash_mismatch": (cell(T, "transaction_rlp", 0, b"changed"), {("transaction_rlp_hash_mismatch", T): 1}),
    "base_fields_missing_on_index_zero": (
        several(cell(F, "parent_hash", 0, None), cell(F, "fee_recipient", 0, None)), {("base_fields_missing_on_index_zero", F): 2}),
    "base_fields_present_on_nonzero_index": (cell(F, "parent_hash", 1, b"\x01" * 32), {("base_fields_present_on_nonzero_index", F): 1}),
    "base_block_number_mismatch": (cell(F, "base_block_number", 0, 7300), {("base_block_number_mismatch", F): 1}),
    "receipt_status_shape_mismatch": (cell(R, "status_kind", 4, "eip658"), {("receipt_status_shape_mismatch", R): 1}),
    "deposit_receipt_field_mismatch": (
        several(cell(R, "deposit_nonce", 0, 1), cell(R, "deposit_receipt_version", 0, 1)), {("deposit_receipt_field_mismatch", R): 1}),
    "topic_count_out_of_range": (cell(L, "topic_count", 3, 5), {("topic_count_out_of_range", L): 1}),
    "topic_count_shape_mismatch": (cell(L, "topic_3", 3, None), {("topic_count_shape_mismatch", L): 1}),
    "orphan_access_list_row": (cell(A, "transaction_ordinal", 0, 99), {("orphan_access_list_row", A): 1}),
    "duplicate_access_list_key": (cell(A, "storage_key_ordinal", 1, 0), {("duplicate_access_list_key", A): 1}),
    "access_list_storage_key_shape_mismatch": (
        cell(A, "storage_key", 3, b"\x01" * 32), {("access_list_storage_key_shape_mismatch", A): 1}),
    "non_contiguous_access_list_ordinals": (cell(A, "access_list_ordinal", 3, 2), {("non_contiguous_access_list_ordinals", A): 1}),
    "non_contiguous_access_storage_key_ordinals": (
        cell(A, "storage_key_ordinal", 2, 3), {("non_contiguous_access_storage_key_ordinals", A): 1}),
    "orphan_authorization_row": (cell(U, "transaction_ordinal", 0, 99), {("orphan_authorization_row", U): 1}),
    "duplicate_authorization_key": (cell(U, "authorization_ordinal", 1, 0), {("duplicate_authorization_key", U): 1}),
    "authorization_non_7702": (to_1559, {("authorization_non_7702", U): 3}),
    "authorization_y_parity_out_of_range": (cell(U, "y_parity", 0, 2), {("authorization_y_parity_out_of_range", U): 1}),
    "non_contiguous_authorization_ordinals": (cell(U, "authorization_ordinal", 2, 3), {("non_contiguous_authorization_ordinals", U): 1}),
    "block_maps_to_multiple_payloads": (split_payload, {("block_maps_to_multiple_payloads", F): 1}),
    "duplicate_content_hash": (copied(F, "content_hash", 0, 1), {("duplicate_content_hash", F): 1}),
    "all_received_time_slots_missing": (cell(F, "received_time_b", 0, None), {("all_received_time_slots_missing", F): 1}),
    "receipt_cumulative_gas_used_not_monotonic": (
        cell(R, "cumulative_gas_used", 2, 80_000), {("receipt_cumulative_gas_used_not_monotonic", R): 1}),
    "payload_starts_after_zero": (reindex({0: 1, 1: 2, 2: 3, 3: 4}), {("payload_starts_after_zero", F): 1}),
    "short_payload_run_length": (clones(4, {0, 1, 2, 3}, first_kept={0}), {("short_payload_run_length", F): 1}),
    "excess_tail_only_payloads": (clones(3, {1, 2}), {("excess_tail_only_payloads", F): 3}),
}
# Defects that cannot help tripping a second rule, exactly as listed. Rows that share an ordinal count as
# sorted by value, so repeated ordinals alone do not trip the gas order.
ALSO = {
    "duplicate_flashblock_key": {"non_contiguous_payload_indexes", "flashblock_count_mismatch"},
    "payload_maps_to_multiple_blocks": {"child_block_number_mismatch"},
    "orphan_child_flashblock": {"flashblock_count_mismatch", "transaction_receipt_hash_mismatch"},
    "flashblock_count_mismatch": {"flashblock_transaction_receipt_count_mismatch", "non_contiguous_transaction_ordinals"},
    "flashblock_transaction_receipt_count_mismatch": {"flashblock_count_mismatch"},
    "duplicate_transaction_ordinal": set(),
    "duplicate_transaction_hash": {
        "transaction_receipt_hash_mismatch", "transaction_rlp_hash_mismatch", "transaction_receipt_type_mismatch"},
    "non_contiguous_transaction_ordinals": {"orphan_access_list_row"},
    "duplicate_receipt_key": {
        "transaction_receipt_hash_mismatch", "transaction_receipt_type_mismatch", "receipt_log_count_mismatch"},
    "transaction_receipt_hash_mismatch": {"receipt_log_count_mismatch"},
    "duplicate_receipt_log_key": {"non_contiguous_log_ordinals"},
    "receipt_log_count_mismatch": {"non_contiguous_log_ordinals"},
    "duplicate_balance_change_key": {"flashblock_count_mismatch"},
    "duplicate_withdrawal_ordinal": {"flashblock_count_mismatch"},
    "transaction_type_mismatch": {"transaction_receipt_type_mismatch", "transaction_optional_field_shape_mismatch"},
    "receipt_type_mismatch": {"transaction_receipt_type_mismatch"},
    "transaction_receipt_type_mismatch": set(),
    "topic_count_out_of_range": set(),
    "orphan_access_list_row": {"non_contiguous_access_storage_key_ordinals"},
    "duplicate_access_list_key": {"non_contiguous_access_storage_key_ordinals"},
    "orphan_authorization_row": {"non_contiguous_authorization_ordinals"},
    "duplicate_authorization_key": {"non_contiguous_authorization_ordinals"},
    "block_maps_to_multiple_payloads": {"payload_starts_after_zero"},
    "excess_tail_only_payloads": {"payload_starts_after_zero"},
    "payload_starts_after_zero": {"base_fields_present_on_nonzero_index"},
    "non_contiguous_payload_indexes": set(),
    "authorization_non_7702": set(),
}
# More defects: name -> (damage, exact fail/warn rules)
EXTRA = {
    "clean": (lambda tables, **_: None, set()),
    "mixed_storage_ordinals": (cell(A, "storage_key_ordinal", 0, None), {"access_list_storage_key_shape_mismatch", "non_contiguous_access_storage_key_ordinals"}),
    "childless_parent": (childless, {"flashblock_count_mismatch"}),
    "unknown_type_label": (
        several(cell(T, "transaction_type", 0, 3), cell(R, "receipt_type", 0, 3)), {"transaction_type_mismatch", "receipt_type_mismatch"}),
    "huge_ordinal": (cell(L, "log_ordinal", 2, 2**64 - 1), {"non_contiguous_log_ordinals"}),
    "huge_index": (reindex({3: 2**64 - 1}), {"non_contiguous_payload_indexes"}),
    "span_counts_gaps": (cell(F, "index", 3, 4), {"non_contiguous_payload_indexes", "orphan_child_flashblock", "flashblock_count_mismatch"}),
    "wrong_hour": (
        lambda tables, day, hour: tables[F][0].update(block_timestamp=tables[F][0]["block_timestamp"] + timedelta(hours=1)), {"partition_date_mismatch"}),
}


def place(position):
    """Partition of the n-th case: every case has its own day and hour."""
    return DAY + timedelta(days=position // 24), position % 24


@pytest.fixture(scope="module")
def result(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    labels = {}
    for position, name in enumerate([*CASES, *EXTRA]):
        day, hour = place(position)
        tables = g.payload_tables(day, hour)
        (CASES.get(name) or EXTRA[name])[0](tables, day=day, hour=hour)
        g.write_partition(root, tables, day, "hour", hour)
        labels[f"{day.isoformat()}T{hour:02d}:00Z"] = name
    outcome = audit(spark, str(root), verify_hashes=True)
    rows = defaultdict(list)
    for row in outcome.findings.collect():
        rows[labels[row["partition"]]].append(row)
    return outcome, rows


@pytest.mark.parametrize("rule", list(CASES))
def test_defect_trips_exactly_its_rules(result, rule):
    _, rows = result
    found = {r["rule_id"] for r in rows[rule]} - METRICS
    assert found == {rule} | ALSO.get(rule, set())
    for (rule_id, dataset), count in CASES[rule][1].items():
        assert [r["count"] for r in rows[rule] if r["rule_id"] == rule_id and r["dataset"] == dataset] == [count]


@pytest.mark.parametrize("name", list(EXTRA))
def test_extra_cases(result, name):
    _, rows = result
    assert {r["rule_id"] for r in rows[name]} - METRICS == EXTRA[name][1]


def test_every_partition_has_all_metrics(result):
    _, rows = result
    for name, found in rows.items():
        counts = defaultdict(int)
        for row in found:
            if row["rule_id"] in METRICS:
                counts[row["rule_id"]] += 1
        assert counts == {
            "tail_only_payload_count": 1, "received_time_slot_coverage": 3, "dataset_physical_stats": 8,
            "payload_run_length_distribution": 1, "flashblock_child_count_distribution": 1, "transaction_type_mix": 1, "empty_dataset_count": 1,
        }, name


def test_run_length_is_a_span(result):
    _, rows = result
    row = next(r for r in rows["span_counts_gaps"] if r["rule_id"] == "payload_run_length_distribution")
    assert row["count"] == 1


def test_severity_status_and_message(result):
    outcome, _ = result
    catalogue = {rule: (severity, status) for rule, severity, status, _ in RULES}
    for row in outcome.findings.select("rule_id", "severity", "status", "message").distinct().collect():
        assert catalogue[row["rule_id"]] == (row["severity"], row["status"]) and row["message"]


def test_all_examples_are_kept(result):
    _, rows = result
    stats = [r for found in rows.values() for r in found if r["rule_id"] == "dataset_physical_stats"]
    assert len(stats) == 8 * len(rows) > 25
    assert all(r["example"] is not None for r in stats)


def test_every_rule_is_covered():
    assert {rule for rule, *_ in RULES} == set(CASES) | PATH_RULES | DRIFT_RULES | METRICS | {"partition_date_mismatch"}
    assert len(RULES) == 68


def test_example_payload(result):
    _, rows = result
    row = next(r for r in rows["duplicate_flashblock_key"] if r["rule_id"] == "payload_run_length_distribution")
    assert json.loads(row["example"]) == {
        "payload_length_count": 1, "payload_length_min": 3, "payload_length_median": 3.0, "payload_length_max": 3}
