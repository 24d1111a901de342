"""A small lake built from the contract: one clean partition that tests then damage."""

from __future__ import annotations

import hashlib
from datetime import date, datetime, timezone
from pathlib import Path
from typing import NamedTuple

import pyarrow as pa
import pyarrow.parquet as pq

from lakeaudit.functions.keccak import digests
from lakeaudit.plans.datasets import CONTRACT, FIRST_ROW_COLUMNS, TYPE_LABELS

F, T, R, L = "flashblocks", "flashblock_transactions", "flashblock_receipts", "flashblock_receipt_logs"
W, B = "flashblock_withdrawals", "flashblock_balance_changes"
A, U = "flashblock_transaction_access_list", "flashblock_transaction_authorizations"
CODES = {label: code for code, label in TYPE_LABELS.items()}
Tables = dict[str, list[dict]]


def arrow_type(kind: str) -> pa.DataType:
    if kind.startswith("fixed_size_binary"):
        return pa.binary(int(kind[len("fixed_size_binary[") : -1]))
    if kind.startswith("timestamp"):
        return pa.timestamp(kind[len("timestamp[") :].split(",")[0], tz="UTC")
    return {"uint64": pa.uint64(), "uint8": pa.uint8(), "binary": pa.binary(), "bool": pa.bool_(), "string": pa.string()}[kind]


def schema(dataset: str) -> pa.Schema:
    return pa.schema([pa.field(n, arrow_type(k), nullable=null) for n, k, null in CONTRACT[dataset]])


def fill(dataset: str, column: str, salt: str) -> object:
    """A deterministic value of the right type for a column whose content does not matter."""
    kind = next(k for n, k, _ in CONTRACT[dataset] if n == column)
    noise = hashlib.sha512(f"{dataset}.{column}.{salt}".encode()).digest() * 4
    if kind.startswith("fixed_size_binary"):
        return noise[: int(kind[len("fixed_size_binary[") : -1])]
    return {"binary": noise[:6], "uint64": noise[0], "uint8": 0, "bool": True, "string": "x"}[kind]


def make_row(dataset: str, salt: str, **values: object) -> dict:
    """Given values, fillers for other required columns, NULL for other nullable ones."""
    unknown = set(values) - {n for n, _, _ in CONTRACT[dataset]}
    assert not unknown, unknown
    return {
        name: values[name] if name in values else None if null else fill(dataset, name, f"{salt}")
        for name, _, null in CONTRACT[dataset]
    }


class Tx(NamedTuple):
    """A transaction and what hangs on it: storage keys per access-list entry, topics per log."""

    kind: str
    input_bytes: int
    gas: int
    access: tuple[int, ...] = ()
    logs: tuple[int, ...] = ()
    authorizations: int = 0


class Step(NamedTuple):
    """One flashblock of the payload."""

    txs: tuple[Tx, ...]
    withdrawals: int
    balance_changes: int


#: Busy first, then quieter, and one that only changes a balance.
PAYLOAD = (
    Step((Tx("eip1559", 12, 31_500, access=(3, 0), logs=(3,)), Tx("deposit", 0, 90_250), Tx("eip7702", 7, 160_000, access=(0,), logs=(0, 2), authorizations=3)), 2, 3),
    Step((Tx("legacy", 2, 52_000, logs=(4, 1)),), 0, 1),
    Step((Tx("eip2930", 4, 47_111, access=(1, 1)), Tx("eip1559", 30, 47_111, access=(0,), logs=(1, 1, 2))), 1, 2),
    Step((), 0, 1),
)
KINDS = tuple(tx.kind for step in PAYLOAD for tx in step.txs)
#: The kind whose receipt holds a state root in place of a status.
ROOTED = "eip2930"
_FEES = ("max_fee_per_gas", "max_priority_fee_per_gas", "chain_id")
_SIGNED = ("nonce", "signature_y_parity", "signature_r", "signature_s")
PRESENT = {
    "legacy": ("gas_price", *_SIGNED), "eip2930": ("gas_price", "chain_id", *_SIGNED), "eip1559": (*_FEES, *_SIGNED), "eip7702": (*_FEES, *_SIGNED),
    "deposit": ("deposit_source_hash", "deposit_mint", "deposit_is_system_transaction"),
}


def payload_tables(day: date, hour: int = 9, tag: str = "p", block: int = 7301, labels=KINDS) -> Tables:
    """The payload above, with other kinds of transactions if asked; every row of a table is numbered in order of its flashblock."""
    out: Tables = {name: [] for name in CONTRACT}
    kinds = iter(labels)

    def add(dataset: str, index: int, **values: object) -> dict:
        if any(n == "block_number" for n, _, _ in CONTRACT[dataset]):
            values["block_number"] = block
        row = make_row(dataset, f"{tag}.{index}.{len(out[dataset])}", payload_id=hashlib.md5(tag.encode()).digest()[:8], index=index, **values)
        out[dataset].append(row)
        return row

    def some(dataset: str, columns) -> dict:
        return {c: fill(dataset, c, f"{tag}.{len(out[dataset])}") for c in columns}

    at = datetime(day.year, day.month, day.day, hour, 30, tzinfo=timezone.utc)
    for index, step in enumerate(PAYLOAD):
        known = {"base_block_number": block, "block_timestamp": at}
        first = {} if index else some(F, [c for c in FIRST_ROW_COLUMNS if c not in known]) | known
        add(F, index, metadata_block_number=block, received_time_b=at, transaction_count=len(step.txs), receipt_count=len(step.txs),
            withdrawal_count=step.withdrawals, balance_change_count=step.balance_changes, **first)
        for ordinal, tx in enumerate(step.txs):
            kind = next(kinds)
            rlp, data = f"{tag}:{kind}:{len(out[T])}".encode(), bytes(range(64, 64 + tx.input_bytes))
            row = add(T, index, transaction_ordinal=ordinal, transaction_hash=digests([rlp])[0], transaction_rlp=rlp, transaction_type=CODES[kind],
                      transaction_type_label=kind, is_contract_creation=False, input=data, input_length=len(data),
                      input_selector=data[:4] if len(data) >= 4 else None, **some(T, ("to_address", *PRESENT[kind])))
            shape = {"status_kind": "post_state_root", **some(R, ["post_state_root"])} if kind == ROOTED else {"status_kind": "eip658", "status": True}
            if kind == "deposit":
                shape |= some(R, ("deposit_nonce", "deposit_receipt_version"))
            add(R, index, transaction_hash=row["transaction_hash"], receipt_type=CODES[kind], receipt_type_label=kind,
                cumulative_gas_used=tx.gas, log_count=len(tx.logs), **shape)
            for number, topics in enumerate(tx.logs):
                add(L, index, transaction_hash=row["transaction_hash"], log_ordinal=number, topic_count=topics, **some(L, [f"topic_{i}" for i in range(topics)]))
            for entry, keys in enumerate(tx.access):
                for number in range(keys) if keys else (None,):
                    key = {} if number is None else some(A, ["storage_key"])
                    add(A, index, transaction_ordinal=ordinal, access_list_ordinal=entry, storage_key_ordinal=number, **key)
            for number in range(tx.authorizations if kind == "eip7702" else 0):
                add(U, index, transaction_ordinal=ordinal, authorization_ordinal=number, y_parity=(number + 1) % 2)
        for number in range(step.withdrawals):
            add(W, index, withdrawal_ordinal=number)
        for _ in range(step.balance_changes):
            add(B, index)
    return out


def merged(*parts: Tables) -> Tables:
    return {name: [row for part in parts for row in part[name]] for name in CONTRACT}


def only_indexes(tables: Tables, indexes: set[int]) -> Tables:
    return {name: [row for row in rows if row["index"] in indexes] for name, rows in tables.items()}


def file_path(root: Path, layout: str, dataset: str, day: date, hour: int = 9) -> Path:
    tree = f"year={day.year:04d}/month={day.month:02d}/day={day.day:02d}"
    if layout == "hour":
        return root / tree / f"hour={hour:02d}" / f"{dataset}_{day.isoformat()}_{hour:02d}.parquet"
    if layout == "date":
        return root / f"date={day.isoformat()}" / f"{dataset}_{day.isoformat()}.parquet"
    return root / dataset / tree / f"{dataset}_{day.isoformat()}.parquet"


def write_table(path: Path, table: pa.Table) -> None:
    path.parent.mkdir(parents=True, exist_ok=True)
    pq.write_table(table, path)


def write_partition(root: Path, tables: Tables, day: date, layout: str = "hour", hour: int = 9) -> None:
    for dataset, rows in tables.items():
        write_table(file_path(root, layout, dataset, day, hour), pa.Table.from_pylist(rows, schema(dataset)))
