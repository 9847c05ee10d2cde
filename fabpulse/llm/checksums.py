"""CRC-32 in SQL that has no such function, for the oracles."""

from __future__ import annotations

# A table `crc` of one row: t[i + 1] is what eight shifts make of the byte i.
CRC_TABLE = (
    "crc(t) AS (SELECT list(list_reduce(list_concat([i], range(8)), lambda a, b:"
    " CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) ORDER BY i)"
    " FROM range(256) AS bytes(i))"
)


def crc_sql(text: str) -> str:
    """The checksum of an ASCII text, where `crc` is joined."""
    return (
        f"xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(range(1, length({text}) + 1),"
        f" lambda i: ascii(substr({text}, i, 1))::BIGINT)),"
        " lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295::BIGINT)"
    )
