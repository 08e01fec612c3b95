"""Shapes of the raw block document.

Each parser declares only the fields it reads, so the JSON parser skips the
rest. ``calls`` stays JSON text: the call tree has no fixed depth.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql.types import ArrayType, StringType, StructField, StructType

# The parser's own limit of 1000 levels would turn a block with a deep call tree into nulls.
JSON_OPTIONS = {"maxNestingDepth": "1000000"}

# Document field -> column, in table order. Fixed by the raw format.
BLOCK_FIELDS = {
    "difficulty": "difficulty",
    "extraData": "extra_data",
    "gasLimit": "gas_limit",
    "gasUsed": "gas_used",
    "hash": "block_hash",
    "logsBloom": "logs_bloom",
    "miner": "miner",
    "mixHash": "mix_hash",
    "nonce": "nonce",
    "parentHash": "parent_hash",
    "receiptsRoot": "receipts_root",
    "sha3Uncles": "sha3_uncles",
    "size": "blocks_size",
    "stateRoot": "state_root",
    "totalDifficulty": "total_difficulty",
    "transactionsRoot": "transactions_root",
}
BASE_FIELDS = {
    "blockHash": "block_hash",
    "from": "base_from",
    "gas": "base_gas_limit",
    "gasPrice": "base_gas_price",
    "input": "base_input",
    "nonce": "base_nonce",
    "to": "base_to",
    "transactionIndex": "base_transaction_index",
    "hash": "base_transaction_hash",
    "value": "base_value",
    "v": "base_v",
    "r": "base_r",
    "s": "base_s",
}
RECEIPT_FIELDS = {
    "blockHash": "block_hash",
    "contractAddress": "receipt_contract_address",
    "cumulativeGasUsed": "receipt_cumulative_gas_used",
    "from": "receipt_from",
    "gasUsed": "receipt_gas_used",
    "logsBloom": "receipt_logs_bloom",
    "root": "receipt_root",
    "to": "receipt_to",
    "transactionIndex": "receipt_transaction_index",
    "transactionHash": "receipt_transaction_hash",
}
LOG_FIELDS = {
    "address": "logs_address",
    "data": "logs_data",
    "blockHash": "block_hash",
    "transactionIndex": "logs_transaction_index",
    "transactionHash": "logs_transaction_hash",
    "logIndex": "logs_index",
    "removed": "logs_removed",
    "id": "logs_id",
}
TRACE_FIELDS = {
    "type": "trace_type",
    "from": "trace_from",
    "to": "trace_to",
    "value": "trace_value",
    "gas": "trace_gas",
    "gasUsed": "trace_gas_used",
    "input": "trace_input",
    "output": "trace_output",
    "time": "trace_time",
    "error": "trace_error",
}
CALL_FIELDS = {
    "type": "calls_type",
    "from": "calls_from",
    "gas": "calls_gas",
    "gasUsed": "calls_gas_used",
    "to": "calls_to",
    "value": "calls_value",
    "input": "calls_input",
    "output": "calls_output",
    "error": "calls_error",
}
UNCLE_FIELDS = {"hash": "uncles_hash", "miner": "uncles_miner", "number": "uncles_number"}


def texts(names: Mapping[str, str] | list[str]) -> StructType:
    """A struct of text fields."""
    return StructType([StructField(name, StringType()) for name in names])


def doc(**fields: StructType | ArrayType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in fields.items()])


def transactions_of(**parts: StructType) -> StructType:
    """``{transactions: [{part: struct, ...}]}``"""
    return doc(transactions=ArrayType(doc(**parts)))


def log() -> StructType:
    return texts([*LOG_FIELDS, "blockNumber"]).add(StructField("topics", ArrayType(StringType())))


def whole_block() -> StructType:
    """All fields that any parser reads, without the call trees."""
    receipt = texts([*RECEIPT_FIELDS, "blockNumber", "status"]).add(StructField("logs", ArrayType(log())))
    parts = transactions_of(base=texts(BASE_FIELDS), receipt=receipt, trace=texts(TRACE_FIELDS))
    uncles = StructField("uncles", ArrayType(texts([*UNCLE_FIELDS, "time"])))
    return StructType([*texts(BLOCK_FIELDS).fields, uncles, *parts.fields])
