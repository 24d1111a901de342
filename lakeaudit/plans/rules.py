"""The rule catalogue: what every rule id means and how serious it is."""

from __future__ import annotations

# Rule ids with their severity and status; the descriptions are our own.
RULES: tuple[tuple[str, str, str, str], ...] = (
    ("missing_required_dataset", "critical", "fail", "a required dataset has no readable file in the partition"),
    ("invalid_parquet_file", "critical", "fail", "the footer of a parquet file cannot be read"),
    ("no_matching_parquet_files", "critical", "fail", "nothing under the root falls into the requested days"),
    ("multiple_readable_files_for_dataset_partition", "critical", "fail", "a dataset has more than one file in the partition"),
    ("schema_mismatch", "critical", "fail", "footer columns differ from the contract in name, type, order or nullability"),
    ("duplicate_flashblock_key", "critical", "fail", "the same payload and index occur on several rows"),
    ("payload_maps_to_multiple_blocks", "critical", "fail", "a payload carries several block numbers"),
    ("non_contiguous_payload_indexes", "critical", "fail", "a payload's indexes skip or repeat a value"),
    ("orphan_child_flashblock", "critical", "fail", "a child key has no flashblock"),
    ("flashblock_count_mismatch", "critical", "fail", "a declared child count differs from the rows present"),
    ("flashblock_transaction_receipt_count_mismatch", "critical", "fail", "declared transactions and receipts differ"),
    ("child_block_number_mismatch", "critical", "fail", "child and flashblock disagree on the block number"),
    ("duplicate_transaction_ordinal", "critical", "fail", "an ordinal repeats inside a flashblock"),
    ("duplicate_transaction_hash", "critical", "fail", "a hash repeats inside a flashblock"),
    ("non_contiguous_transaction_ordinals", "critical", "fail", "ordinals do not run from zero to the declared count"),
    ("duplicate_receipt_key", "critical", "fail", "a receipt repeats inside a flashblock"),
    ("transaction_receipt_hash_mismatch", "critical", "fail", "transactions and receipts cover different hashes"),
    ("duplicate_receipt_log_key", "critical", "fail", "a log ordinal repeats inside a receipt"),
    ("receipt_log_count_mismatch", "critical", "fail", "a receipt's declared logs differ from the rows present"),
    ("non_contiguous_log_ordinals", "critical", "fail", "log ordinals do not run from zero to the declared count"),
    ("duplicate_balance_change_key", "critical", "fail", "an address repeats inside a flashblock"),
    ("duplicate_withdrawal_ordinal", "critical", "fail", "a withdrawal ordinal repeats inside a flashblock"),
    ("non_contiguous_withdrawal_ordinals", "critical", "fail", "withdrawal ordinals do not run from zero to the declared count"),
    ("transaction_type_mismatch", "critical", "fail", "code and label of a transaction type disagree"),
    ("receipt_type_mismatch", "critical", "fail", "code and label of a receipt type disagree"),
    ("transaction_receipt_type_mismatch", "critical", "fail", "a transaction and its receipt carry different labels"),
    ("transaction_optional_field_shape_mismatch", "critical", "fail", "optional fields do not fit the transaction type"),
    ("contract_creation_flag_mismatch", "critical", "fail", "the creation flag contradicts the recipient"),
    ("transaction_input_length_mismatch", "critical", "fail", "the declared input length is not its byte length"),
    ("transaction_input_selector_mismatch", "critical", "fail", "the selector is not the first four input bytes"),
    ("transaction_rlp_hash_mismatch", "critical", "fail", "the stored hash is not the Keccak-256 of the encoded transaction"),
    ("base_fields_missing_on_index_zero", "critical", "fail", "a first row lacks base fields"),
    ("base_fields_present_on_nonzero_index", "critical", "fail", "a later row carries base fields"),
    ("base_block_number_mismatch", "critical", "fail", "base and metadata block number differ on a first row"),
    ("receipt_status_shape_mismatch", "critical", "fail", "status fields do not fit the status kind"),
    ("deposit_receipt_field_mismatch", "critical", "fail", "deposit fields do not fit the receipt type"),
    ("topic_count_out_of_range", "critical", "fail", "a log claims more than four topics"),
    ("topic_count_shape_mismatch", "critical", "fail", "the topics set do not fit the topic count"),
    ("orphan_access_list_row", "critical", "fail", "an access-list entry has no transaction"),
    ("duplicate_access_list_key", "critical", "fail", "an access-list key repeats"),
    ("access_list_storage_key_shape_mismatch", "critical", "fail", "storage keys of an entry are partly set"),
    ("non_contiguous_access_list_ordinals", "critical", "fail", "access-list ordinals do not run from zero"),
    ("non_contiguous_access_storage_key_ordinals", "critical", "fail", "storage-key ordinals do not run from zero"),
    ("orphan_authorization_row", "critical", "fail", "an authorization has no transaction"),
    ("duplicate_authorization_key", "critical", "fail", "an authorization key repeats"),
    ("authorization_non_7702", "critical", "fail", "an authorization belongs to another transaction type"),
    ("authorization_y_parity_out_of_range", "critical", "fail", "an authorization parity is neither 0 nor 1"),
    ("non_contiguous_authorization_ordinals", "critical", "fail", "authorization ordinals do not run from zero"),
    ("partition_parse_error", "high", "warn", "the path fits no supported layout"),
    ("block_maps_to_multiple_payloads", "high", "warn", "a block number occurs under several payloads"),
    ("duplicate_content_hash", "high", "warn", "a content hash occurs on several flashblocks"),
    ("all_received_time_slots_missing", "high", "warn", "a flashblock has no arrival time at all"),
    ("partition_date_mismatch", "high", "warn", "file name or block time contradict the partition"),
    ("receipt_cumulative_gas_used_not_monotonic", "high", "warn", "cumulative gas falls along the transactions"),
    ("mixed_storage_layout_for_partition", "high", "warn", "a partition is stored in several layouts"),
    ("unknown_dataset", "high", "warn", "a partition holds a dataset outside the contract"),
    ("payload_starts_after_zero", "medium", "warn", "a payload starts after index zero"),
    ("short_payload_run_length", "medium", "warn", "some payloads are far shorter than usual for the partition"),
    ("excess_tail_only_payloads", "medium", "warn", "unusually many payloads start after index zero"),
    ("dataset_physical_drift", "medium", "warn", "physical size of a dataset left the range of its peers"),
    ("transaction_type_mix_drift", "medium", "warn", "shares of transaction types left the range of the peers"),
    ("tail_only_payload_count", "low", "metric", "payloads that start after index zero"),
    ("received_time_slot_coverage", "low", "metric", "rows with an arrival time, per slot"),
    ("dataset_physical_stats", "low", "metric", "physical size of a dataset"),
    ("payload_run_length_distribution", "low", "metric", "lengths of the payloads"),
    ("flashblock_child_count_distribution", "low", "metric", "declared child counts"),
    ("transaction_type_mix", "low", "metric", "shares of transaction types"),
    ("empty_dataset_count", "low", "metric", "datasets without rows"),
)
