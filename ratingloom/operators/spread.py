"""Joins that survive a key holding a large share of all rows, and checked broadcasts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

HOT_SHARE = 1 / 256
# A lookup is broadcast if its rows, as text with some bytes per field, stay below this.
BROADCAST_BYTES = 32 << 20
FIELD_BYTES = 16


def _key_hash(df: DataFrame, keys: list[str], types: dict[str, str]) -> Column:
    return F.xxhash64(*[df[k].cast(types[k]) for k in keys])


def hot_keys(df: DataFrame, keys: list[str], share: float = HOT_SHARE) -> tuple[dict[int, int], int]:
    """Hash and count of the keys that hold more than ``share`` of the rows, at most 1/share of them, and
    the number of rows.

    One pass over the key columns with a mergeable sketch; no shuffle of the rows. The answer only
    decides how rows are spread, so the sketch's error never touches a result.
    """
    types = dict(df.dtypes)
    limit = int(1 / share)
    found = (df.select(_key_hash(df, keys, types).alias("h"))
             .agg(F.expr(f"approx_top_k(h, {limit}, {limit * 16})").alias("top"),
                  F.count("*").alias("rows"))
             .first())
    return {i["item"]: i["count"] for i in found["top"] or [] if i["count"] > share * found["rows"]}, found["rows"]


def is_small(lookup: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether the lookup's size, counted over its rows, stays below ``max_bytes``. Reads no more
    rows than could fit."""
    most = max_bytes // FIELD_BYTES // max(1, len(lookup.columns)) + 1
    sizes = [F.coalesce(F.octet_length(F.to_json(F.struct(c)) if "<" in t else F.col(c).cast("string")), F.lit(0))
             + FIELD_BYTES for c, t in lookup.dtypes]
    size = reduce(lambda a, b: a + b, sizes) if sizes else F.lit(0)
    return (lookup.limit(most).select(size.cast("long").alias("n")).agg(F.sum("n")).first()[0] or 0) < max_bytes


def look(facts: DataFrame, lookup: DataFrame, keys: list[str],
         looked: dict[tuple[str, ...], tuple[dict[int, int], int]] | None = None) -> dict:
    """The hot values of each of ``keys`` in written ``facts``, for joins with ``lookup`` that follow one another on one key
    each: they need neither write nor look at what they make of the facts. Those ``looked`` at before, in nearly the
    same facts, are kept; a lookup that is broadcast needs none."""
    looked = dict(looked or {})
    if not is_small(lookup):
        for key in keys:
            if (key,) not in looked:
                looked[key,] = hot_keys(facts, [key])
    return looked


def spread_join(facts: DataFrame, lookup: DataFrame, keys: list[str], how: str = "inner",
                share: float = HOT_SHARE, row_id: str | None = None,
                max_bytes: int = BROADCAST_BYTES, looked: dict | None = None) -> DataFrame:
    """Equi-join of many ``facts`` with a ``lookup`` that holds few rows per key.

    A lookup of checked small size is broadcast. Otherwise a key that holds more than ``share`` of the
    facts is dealt over as many sub-keys as bring each below that share, and the few lookup rows of that
    key are repeated for each: at most 2/share repeats of a row in all. Other keys are untouched. Rows are
    dealt by a hash of ``row_id``, or of all columns, which is the same in a repeated task; facts with
    many equal rows need a ``row_id`` to be dealt evenly. ``looked`` has hot keys that ``look`` found. ``how`` must keep the fact side: inner, left,
    left_semi or left_anti.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"cannot spread a {how} join")
    if is_small(lookup, max_bytes):
        return facts.join(F.broadcast(lookup), keys, how)
    hot, rows = (looked or {}).get(tuple(keys)) or hot_keys(facts, keys, share)
    if not hot:
        return facts.join(lookup, keys, how)
    types = dict(facts.dtypes)
    parts = F.create_map(*[F.lit(x) for h, n in hot.items() for x in (h, int(n / (share * rows)) + 1)])

    def dealt(df: DataFrame) -> Column:
        return F.coalesce(parts[_key_hash(df, keys, types)], F.lit(1))

    by = [row_id] if row_id else [c for c, t in facts.dtypes if not t.startswith("map")]
    salted_facts = facts.withColumn(
        "_salt", F.pmod(F.xxhash64(*[facts[c] for c in by]), dealt(facts)).cast("int"))
    salted_lookup = lookup.withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), dealt(lookup) - 1)))
    return salted_facts.join(salted_lookup, [*keys, "_salt"], how).drop("_salt")


def lookup_join(facts: DataFrame, lookup: DataFrame, keys: list[str], how: str = "inner",
                small: bool | None = None) -> DataFrame:
    """Join with a word list, lexicon or code table. ``small`` says that its size is known to be
    bounded; else it is checked."""
    if small:
        return facts.join(F.broadcast(lookup), keys, how)
    return spread_join(facts, lookup, keys, how)
