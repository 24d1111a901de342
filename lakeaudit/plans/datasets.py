"""The eight related tables of the lake: exact footer contract and key structure."""

from __future__ import annotations

# Column name, Arrow type in the parquet footer, and whether the column is nullable.
# Order matters; all eight datasets are required in every partition.
CONTRACT: dict[str, list[tuple[str, str, bool]]] = {
    "flashblocks": [
        ("payload_id", "fixed_size_binary[8]", False),
        ("index", "uint64", False),
        ("content_hash", "fixed_size_binary[32]", False),
        ("received_time_a", "timestamp[ns, tz=UTC]", True),
        ("received_time_b", "timestamp[ns, tz=UTC]", True),
        ("received_time_c", "timestamp[ns, tz=UTC]", True),
        ("metadata_block_number", "uint64", False),
        ("parent_beacon_block_root", "fixed_size_binary[32]", True),
        ("parent_hash", "fixed_size_binary[32]", True),
        ("fee_recipient", "fixed_size_binary[20]", True),
        ("prev_randao", "fixed_size_binary[32]", True),
        ("base_block_number", "uint64", True),
        ("gas_limit", "uint64", True),
        ("block_timestamp", "timestamp[ms, tz=UTC]", True),
        ("extra_data", "binary", True),
        ("base_fee_per_gas", "fixed_size_binary[32]", True),
        ("state_root", "fixed_size_binary[32]", False),
        ("receipts_root", "fixed_size_binary[32]", False),
        ("logs_bloom", "fixed_size_binary[256]", False),
        ("gas_used", "uint64", False),
        ("block_hash", "fixed_size_binary[32]", False),
        ("withdrawals_root", "fixed_size_binary[32]", False),
        ("blob_gas_used", "uint64", True),
        ("transaction_count", "uint64", False),
        ("withdrawal_count", "uint64", False),
        ("balance_change_count", "uint64", False),
        ("receipt_count", "uint64", False),
    ],
    "flashblock_withdrawals": [
        ("payload_id", "fixed_size_binary[8]", False),
        ("index", "uint64", False),
        ("block_number", "uint64", False),
        ("withdrawal_ordinal", "uint64", False),
        ("withdrawal_index", "uint64", False),
        ("validator_index", "uint64", False),
        ("address", "fixed_size_binary[20]", False),
        ("amount", "uint64", False),
    ],
    "flashblock_transactions": [
        ("payload_id", "fixed_size_binary[8]", False),
        ("index", "uint64", False),
        ("transaction_ordinal", "uint64", False),
        ("block_number", "uint64", False),
        ("transaction_hash", "fixed_size_binary[32]", False),
        ("transaction_type", "uint8", False),
        ("transaction_type_label", "string", False),
        ("from_address", "fixed_size_binary[20]", False),
        ("to_address", "fixed_size_binary[20]", True),
        ("chain_id", "uint64", True),
        ("nonce", "uint64", True),
        ("gas_limit", "uint64", False),
        ("value", "fixed_size_binary[32]", False),
        ("gas_price", "fixed_size_binary[16]", True),
        ("max_fee_per_gas", "fixed_size_binary[16]", True),
        ("max_priority_fee_per_gas", "fixed_size_binary[16]", True),
        ("input", "binary", False),
        ("signature_y_parity", "bool", True),
        ("signature_r", "fixed_size_binary[32]", True),
        ("signature_s", "fixed_size_binary[32]", True),
        ("deposit_source_hash", "fixed_size_binary[32]", True),
        ("deposit_mint", "fixed_size_binary[16]", True),
        ("deposit_is_system_transaction", "bool", True),
        ("is_contract_creation", "bool", False),
        ("input_selector", "fixed_size_binary[4]", True),
        ("input_length", "uint64", False),
        ("transaction_rlp", "binary", False),
    ],
    "flashblock_transaction_access_list": [
        ("payload_id", "fixed_size_binary[8]", False),
        ("index", "uint64", False),
        ("transaction_ordinal", "uint64", False),
        ("access_list_ordinal", "uint64", False),
        ("address", "fixed_size_binary[20]", False),
        ("storage_key_ordinal", "uint64", True),
        ("storage_key", "fixed_size_binary[32]", True),
    ],
    "flashblock_transaction_authorizations": [
        ("payload_id", "fixed_size_binary[8]", False),
        ("index", "uint64", False),
        ("transaction_ordinal", "uint64", False),
        ("authorization_ordinal", "uint64", False),
        ("chain_id", "fixed_size_binary[32]", False),
        ("address", "fixed_size_binary[20]", False),
        ("nonce", "uint64", False),
        ("y_parity", "uint8", False),
        ("r", "fixed_size_binary[32]", False),
        ("s", "fixed_size_binary[32]", False),
    ],
    "flashblock_receipts": [
        ("payload_id", "fixed_size_binary[8]", False),
        ("index", "uint64", False),
        ("block_number", "uint64", False),
        ("transaction_hash", "fixed_size_binary[32]", False),
        ("receipt_type", "uint8", False),
        ("receipt_type_label", "string", False),
        ("status_kind", "string", False),
        ("status", "bool", True),
        ("post_state_root", "fixed_size_binary[32]", True),
        ("cumulative_gas_used", "uint64", False),
        ("deposit_nonce", "uint64", True),
        ("deposit_receipt_version", "uint64", True),
        ("log_count", "uint64", False),
    ],
    "flashblock_receipt_logs": [
        ("payload_id", "fixed_size_binary[8]", False),
        ("index", "uint64", False),
        ("block_number", "uint64", False),
        ("transaction_hash", "fixed_size_binary[32]", False),
        ("log_ordinal", "uint64", False),
        ("address", "fixed_size_binary[20]", False),
        ("topic_count", "uint64", False),
        ("topic_0", "fixed_size_binary[32]", True),
        ("topic_1", "fixed_size_binary[32]", True),
        ("topic_2", "fixed_size_binary[32]", True),
        ("topic_3", "fixed_size_binary[32]", True),
        ("data", "binary", False),
    ],
    "flashblock_balance_changes": [
        ("payload_id", "fixed_size_binary[8]", False),
        ("index", "uint64", False),
        ("block_number", "uint64", False),
        ("address", "fixed_size_binary[20]", False),
        ("balance", "fixed_size_binary[32]", False),
    ],
}

# Transaction type codes.
TYPE_LABELS = {0: "legacy", 1: "eip2930", 2: "eip1559", 4: "eip7702", 126: "deposit"}

# Columns set exactly on the first row (index zero) of a payload.
FIRST_ROW_COLUMNS = (
    "parent_beacon_block_root",
    "parent_hash",
    "fee_recipient",
    "prev_randao",
    "base_block_number",
    "gas_limit",
    "block_timestamp",
    "extra_data",
    "base_fee_per_gas",
)

RECEIVED_SLOTS = ("received_time_a", "received_time_b", "received_time_c")
SIGNATURE = ("signature_y_parity", "signature_r", "signature_s")
DEPOSIT = ("deposit_source_hash", "deposit_mint", "deposit_is_system_transaction")
DYNAMIC_FEES = ("max_fee_per_gas", "max_priority_fee_per_gas")

# Per transaction type the columns that must be set and those that must be NULL.
TYPE_CONTRACT = {
    "legacy": (("gas_price", "nonce", *SIGNATURE), (*DYNAMIC_FEES, *DEPOSIT)),
    "eip2930": (("gas_price", "chain_id", "nonce", *SIGNATURE), (*DYNAMIC_FEES, *DEPOSIT)),
    "eip1559": ((*DYNAMIC_FEES, "chain_id", "nonce", *SIGNATURE), ("gas_price", *DEPOSIT)),
    "eip7702": ((*DYNAMIC_FEES, "chain_id", "nonce", *SIGNATURE), ("gas_price", *DEPOSIT)),
    "deposit": (DEPOSIT, ("gas_price", *DYNAMIC_FEES, "chain_id", "nonce", *SIGNATURE)),
}

STATUS_CONTRACT = {"eip658": (("status",), ("post_state_root",)), "post_state_root": (("post_state_root",), ("status",))}

REQUIRED_DATASETS = tuple(CONTRACT)
