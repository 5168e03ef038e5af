"""CRC-32 as a SQL expression, for engines without the function."""

from __future__ import annotations


def crc32_sql(text: str) -> str:
    """Unsigned CRC-32 of an ASCII text expression: half a byte at a time, by a table made from the reflected polynomial."""
    table = []
    for value in range(16):
        for _ in range(4):
            value = (value >> 1) ^ (0xEDB88320 if value & 1 else 0)
        table.append(value)
    entries = f"[{', '.join(f'{value}::UBIGINT' for value in table)}]"

    def half(crc: str) -> str:
        return f"xor(({crc}) >> 4, {entries}[CAST(({crc}) & 15 AS BIGINT) + 1])"

    bytes_ = f"list_transform(string_split({text}, ''), lambda c: CAST(ascii(c) AS UBIGINT))"
    return (
        f"CAST(xor(list_reduce(list_prepend(4294967295::UBIGINT, {bytes_}), "
        f"lambda crc, b: {half(half('xor(crc, b)'))}), 4294967295::UBIGINT) AS BIGINT)"
    )
