"""Pieces of DuckDB SQL that several oracles share."""

from __future__ import annotations

#: A one-row table ``crc_table(tab)``: the 256 remainders of the reflected polynomial 0xEDB88320.
CRC_TABLE = """crc_table AS MATERIALIZED (SELECT list_transform(range(256), lambda i: list_reduce(range(8),
  lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END, i::BIGINT)) AS tab)"""


def crc32(text: str) -> str:
    """The unsigned CRC-32 of the UTF-8 bytes of ``text``, beside ``crc_table`` in FROM."""
    octets = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda b: ('0x' || b)::BIGINT)"
    return f"xor(list_reduce({octets}, lambda c, x: xor(c >> 8, tab[xor(c & 255, x) + 1]), 4294967295::BIGINT), 4294967295)"


def md5_bits(text: str, digits: int = 13) -> str:
    """The first ``digits`` hexadecimal digits of the MD5 of ``text`` as a number."""
    return f"('0x' || substr(md5({text}), 1, {digits}))::BIGINT"
