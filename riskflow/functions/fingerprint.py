"""Transaction id and payload fingerprint expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from riskflow.schemas import HASH_FIELDS

ID_PREFIX_LENGTH = 4
FINGERPRINT_LENGTH = 32

_CANONICAL_UUID = "^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
_HEX_GROUPS = "[0-9a-fA-F]{4}(-?[0-9a-fA-F]{4}){7}"
_UUID_TEXT = rf"^({_HEX_GROUPS}|\{{{_HEX_GROUPS}\}})$"


def strip_prefix(transaction_id: Column) -> Column:
    """Drop the first four characters, whatever they are."""
    return F.substr(transaction_id, F.lit(ID_PREFIX_LENGTH + 1))


def positional(number: Column) -> Column:
    """Shortest text of a double without an exponent from 1e-4 up to 1e16, as ``12345678.9``.

    Spark writes ``1.23456789E7`` from ten million up and below a thousandth. The digits are the same,
    so the point is moved: behind ``exponent`` more digits, or behind as many zeros. Further out
    the exponent stays, in the short form ``1e16``.

    Few numbers have an exponent, and the code for them is kept short: longer methods are not compiled. Of
    at most 17 digits, a number in that range is a decimal of 17 places before the point and 21 behind it.
    """
    text = number.cast("string")
    moved = F.rtrim(text.try_cast("decimal(38,21)").cast("string"), F.lit("0"))
    within = (F.abs(number) >= 1e-4) & (F.abs(number) < 1e16)
    short = F.replace(F.replace(text, F.lit(".0E"), F.lit("E")), F.lit("E"), F.lit("e"))
    return (
        F.when(~F.contains(text, F.lit("E")), text)
        .when(within, F.when(F.endswith(moved, F.lit(".")), F.concat(moved, F.lit("0"))).otherwise(moved))
        .otherwise(short)
    )


def amount_text(amount: Column, style: str = "positional") -> Column:
    """Text of an amount inside the fingerprint.

    ``positional`` is the shortest text without an exponent (:func:`positional`), ``shortest``
    Spark's own (``1.0E7`` from ten million up); ``plain`` writes amounts that are exact to
    two decimals with two decimals.
    """
    if style == "positional":
        return positional(amount)
    if style == "shortest":
        return amount.cast("string")
    if style == "plain":
        plain = amount.try_cast("decimal(38,2)")
        return F.when(plain.cast("double") == amount, plain.cast("string")).otherwise(positional(amount))
    raise ValueError(f"unknown amount style: {style}")


def payload_hash(amount_style: str = "positional", transaction_id: Column | None = None) -> Column:
    """First 32 hex digits of the SHA-256 over the six payload fields, bar-separated.

    Uses the stripped but otherwise raw id, ``transaction_id`` if the column of that name is something else. ``concat``
    keeps a null operand null, where ``concat_ws`` would skip it.
    """
    parts: list[Column] = []
    for name in HASH_FIELDS:
        text = amount_text(F.col(name), amount_style) if name == "amount" else F.col(name)
        if name == "transaction_id" and transaction_id is not None:
            text = transaction_id
        parts += [F.lit("|"), text]
    return F.substring(F.sha2(F.concat(*parts[1:]), 256), 1, FINGERPRINT_LENGTH)


#: Bytes in front of a key that is not hexadecimal: what is packed is 16 bytes long, the rest longer.
_UNPACKED = bytes(17)


def _packed(text: Column, pattern: str) -> Column:
    other = F.concat(F.lit(_UNPACKED), F.encode(text, "UTF-8"))
    known = F.when(text.rlike(pattern), F.unhex(F.translate(text, "-", ""))).otherwise(other)
    # Never null, so that no filter for nulls tells two uses of one shuffle apart.
    return F.coalesce(known, F.lit(b""))


def _unpacked(packed: Column, written: Column) -> Column:
    other = F.decode(F.substr(packed, F.lit(len(_UNPACKED) + 1)), "UTF-8")
    return F.when(F.octet_length(packed) == 16, written).when(F.octet_length(packed) > 16, other)


def packed_id(text: Column) -> Column:
    """An id as 16 bytes if it is a UUID in canonical form, else its text behind a mark, a null as no bytes."""
    return _packed(text, _CANONICAL_UUID)


def unpacked_id(packed: Column) -> Column:
    digits = F.lower(F.hex(packed))
    groups = [F.substring(digits, at, size) for at, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return _unpacked(packed, F.concat_ws("-", *groups))


def packed_hash(text: Column) -> Column:
    """A payload fingerprint as 16 bytes, any other text behind a mark."""
    return _packed(text, f"^[0-9a-f]{{{FINGERPRINT_LENGTH}}}$")


def unpacked_hash(packed: Column) -> Column:
    return _unpacked(packed, F.lower(F.hex(packed)))


def with_packed_ids(rows: DataFrame) -> DataFrame:
    return rows.withColumn("transaction_id", packed_id(F.col("transaction_id")))


def with_packed_keys(rows: DataFrame) -> DataFrame:
    """Ids and fingerprints of ``rows`` packed, in place."""
    return rows.withColumns({
        "transaction_id": packed_id(F.col("transaction_id")), "payload_hash": packed_hash(F.col("payload_hash")),
    })


def with_unpacked_keys(rows: DataFrame) -> DataFrame:
    return rows.withColumns({
        "transaction_id": unpacked_id(F.col("transaction_id")), "payload_hash": unpacked_hash(F.col("payload_hash")),
    })


def canonical_uuid(text: Column) -> Column:
    """Lower-case hyphenated UUID, or null when the text is not a UUID.

    Accepts what a SQL ``UUID`` column accepts: any letter case, optional braces,
    optional hyphens between groups of four digits. Text in canonical form already, the
    usual case, costs one match.
    """
    digits = F.lower(F.translate(text, "{}-", ""))
    groups = [F.substring(digits, at, size) for at, size in
              ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.when(text.rlike(_CANONICAL_UUID), text).when(
        text.rlike(_UUID_TEXT), F.concat_ws("-", *groups)
    )
