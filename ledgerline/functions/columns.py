"""Column-level helpers. All are built-in Spark expressions, so they stay inside
whole-stage codegen; nothing here runs Python per row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..schemas import AMOUNT_DECIMAL, SUM_DECIMAL

# leading/trailing characters that Python's str.strip() removes and Java's
# plain \s does not (Unicode spaces and the four ASCII separators).
_STRIP_CLASS = r"[\s\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
_STRIP_PATTERN = rf"^{_STRIP_CLASS}+|{_STRIP_CLASS}+$"


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c) -> Column:
    """NaN becomes NULL (pandas treats NaN as missing; Spark orders NaN above every number)."""
    c = col_(c)
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)


def normalize_address(c) -> Column:
    """Lower case, then strip leading/trailing whitespace (tabs, newlines, Unicode spaces)."""
    return F.regexp_replace(F.lower(col_(c)), _STRIP_PATTERN, "")


def hex_address(id_col) -> Column:
    """'0x' + md5 of the id's text: the address format of the ledger (34 characters)."""
    return F.concat(F.lit("0x"), F.md5(col_(id_col).cast("string")))


def pack_hex(c) -> Column:
    """A text as bytes, '0x' and lower-case hex digits in half of theirs. Equal bytes are equal texts; NULL stays NULL.

    Random hex digits are the one part of a row that no fast codec shrinks, so a hash travels through a shuffle like
    this. ``unpack_hex`` gives the text back; what doesn't come back from its digits is kept as it is.
    """
    text = col_(c)
    digits = F.unhex(F.substring(text, 3, 2_147_483_647))
    same = F.coalesce(F.concat(F.lit("0x"), F.lower(F.hex(digits))) == text, F.lit(False))
    return F.when(same, F.concat(F.lit(bytearray(b"\x01")), digits)).otherwise(F.concat(F.lit(bytearray(b"\x00")), text.cast("binary")))


def unpack_hex(c) -> Column:
    """The text that ``pack_hex`` made bytes of."""
    packed = col_(c)
    rest = F.substring(packed, 2, 2_147_483_647)
    return (F.when(F.substring(packed, 1, 1) == F.lit(bytearray(b"\x01")), F.concat(F.lit("0x"), F.lower(F.hex(rest))))
            .otherwise(rest.cast("string")))


def packed_key(df: DataFrame, key: str) -> tuple[Column, Callable[[str], Column]]:
    """(what column ``key`` travels as, the way back): a plain text goes as ``pack_hex``, anything else as it is."""
    return (pack_hex(key), unpack_hex) if df.schema[key].dataType == StringType() else (F.col(key), F.col)


def tx_hash_of(*parts) -> Column:
    """'0x' + SHA-256 of the concatenated fields (66 characters)."""
    return F.concat(F.lit("0x"), F.sha2(F.concat_ws("", *[col_(p).cast("string") for p in parts]), 256))


def block_of(tx_id) -> Column:
    """Ten transactions per block: tx_id div 10 + 1."""
    return (F.floor(col_(tx_id) / F.lit(10)) + F.lit(1)).cast("bigint")


def money(c) -> Column:
    """Money in the warehouse type DECIMAL(18,8); the validation rule ``money_fits`` keeps out what it
    cannot hold."""
    return col_(c).cast(AMOUNT_DECIMAL)


def wide_money(c) -> Column:
    """Money as DECIMAL(28,8) for sums: exact, independent of partition order, and wide enough for
    amounts that the warehouse type cannot hold."""
    return col_(c).cast(SUM_DECIMAL)


def money_sum(c) -> Column:
    """Exact sum of a money column, returned as DOUBLE."""
    return F.sum(wide_money(c)).cast("double")


def money_avg(c) -> Column:
    """Mean as exact decimal sum / non-null count (NULL for an empty group)."""
    return F.try_divide(F.sum(wide_money(c)).cast("double"), F.count(col_(c)).cast("double"))


def count_where(cond: Column) -> Column:
    """Conditional count that is 0 (not NULL) when nothing matches."""
    return F.count_if(cond).cast("bigint")


def ratio(num, den) -> Column:
    """num / den, NULL when den is 0 or NULL (ANSI division would raise)."""
    return F.try_divide(col_(num).cast("double"), col_(den).cast("double"))
