"""Jump consistent hashing: a stable key's shard without a table of shards.

The key walks through its own pseudo-random jumps (a 64-bit congruential sequence)
and stays at the last one below the number of shards, so a further shard takes rows
only into itself.  All of it is Column arithmetic: 64-bit products are made of limbs
of 24, 24 and 16 bits, which never leave a signed long.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import CHUNKS, number_from_zero

MULTIPLIER = 2862933555777941757
#: Jumps made at once; a key needs ln(shards) on average, and whoever needs more goes on.
USUAL_JUMPS = 24
OVERHEAD_BYTES = 16


def _limbs(value: int) -> tuple[int, int, int]:
    return value & 0xFFFFFF, value >> 24 & 0xFFFFFF, value >> 48


def _hex(digest: Column, start: int, width: int) -> Column:
    return F.conv(F.substring(digest, start, width), 16, 10).cast("bigint")


def _jump(state: Column, shards: Column) -> Column:
    m0, m1, m2 = (F.lit(m).cast("bigint") for m in _limbs(MULTIPLIER))
    k0, k1, k2 = state["k0"], state["k1"], state["k2"]
    low = k0 * m0 + 1
    middle = F.shiftright(low, 24) + k0 * m1 + k1 * m0
    high = F.shiftright(middle, 24) + k0 * m2 + k1 * m1 + k2 * m0
    key = F.struct(
        low.bitwiseAND(F.lit(0xFFFFFF)).alias("k0"), middle.bitwiseAND(F.lit(0xFFFFFF)).alias("k1"),
        high.bitwiseAND(F.lit(0xFFFF)).alias("k2"), state["at"].alias("at"), state["next"].alias("next"),
    )
    # a lambda's argument is computed once: the new key, then the jump drawn from its top 31 bits
    moved = F.transform(F.array(key), lambda s: F.struct(
        s["k0"].alias("k0"), s["k1"].alias("k1"), s["k2"].alias("k2"), s["next"].alias("at"),
        ((s["next"] + 1) * (F.lit(2147483648.0) / (F.shiftleft(s["k2"], 15) + F.shiftright(s["k1"], 9) + 1))).cast("bigint").alias("next"),
    ))[0]
    return F.when(state["next"] < shards, moved).otherwise(state)


def jump_state(digest: Column, shards: int) -> Column:
    """Struct with ``at``, the shard, and ``next``, the first jump beyond the shards.

    ``digest`` is a hexadecimal digest of the key, of 16 digits at least.
    """
    count = F.lit(shards).cast("bigint")
    start = F.struct(
        _hex(digest, 11, 6).alias("k0"), _hex(digest, 5, 6).alias("k1"), _hex(digest, 1, 4).alias("k2"),
        F.lit(-1).cast("bigint").alias("at"), F.lit(0).cast("bigint").alias("next"),
    )
    usual = F.aggregate(F.sequence(F.lit(1), F.lit(min(USUAL_JUMPS, shards))), start, lambda s, _: _jump(s, count))
    if shards <= USUAL_JUMPS:
        return usual
    # at least one shard further with each jump, so as many jumps as shards always suffice
    rest = lambda s: F.aggregate(F.sequence(F.lit(USUAL_JUMPS + 1), F.lit(shards)), s, lambda t, _: _jump(t, count))
    return F.transform(F.array(usual), lambda s: F.when(s["next"] < count, rest(s)).otherwise(s))[0]


def key_digest(key: str) -> Column:
    return F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary"))


def shard_rows(df: DataFrame, key: str, text: str, shards: int) -> DataFrame:
    """Add size, text_crc32, law, shard, slot and grown_shard (with one shard more).

    Input columns of these names are replaced, all others stay.  A null key counts as the
    empty string, so all null keys share a shard; equal keys share one too.  A null text
    has no bytes and the checksum of the empty text.  Slots number the rows of a shard
    without gaps, in the order of a digest of the key, the key, the size and the checksum;
    rows alike in all of these take their slots in any order.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    made = {"size", "text_crc32", "law", "shard", "slot", "grown_shard"}

    def placed(source: DataFrame) -> DataFrame:
        jumped = source.withColumn("__digest", key_digest(key)).withColumn("__jump", jump_state(F.col("__digest"), shards))
        return jumped.withColumns({
            "shard": F.col("__jump.at").cast("int"),
            "grown_shard": F.when(F.col("__jump.next") == shards, shards).otherwise(F.col("__jump.at")).cast("int"),
            "__part": (_hex(F.col("__digest"), 17, 4) % CHUNKS).cast("int"),
        })

    kept = [c for c in df.columns if c not in made or c in (key, text)]
    rows = placed(df.select(*kept)).withColumns({
        "size": (F.coalesce(F.octet_length(text), F.lit(0)) + OVERHEAD_BYTES).cast("bigint"),
        "text_crc32": F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")),
        "law": F.lit("key"),
    })
    order = ["__key", "size", "text_crc32"]
    numbered = number_from_zero(
        rows.withColumn("__key", F.col(key)).drop("__digest", "__jump", *([text] if text not in kept else [])),
        ["shard"], order, F.col("__part"), "slot", narrow=placed(df.select(key)),
    )
    others = [c for c in kept if c not in made]
    return numbered.select(*others, "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def query(spark, sf_dir):
    from .common import table

    rows = shard_rows(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text", 40)
    return rows.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


SQL = """
WITH RECURSIVE crc_table AS (
  SELECT list(c ORDER BY b) AS t FROM (
    SELECT b, list_reduce(list_prepend(b::BIGINT, range(8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM (SELECT unnest(range(256)) AS b))
), d AS (
  SELECT doc_id, coalesce(text, '') AS text, md5(coalesce(doc_id::VARCHAR, '')) AS h FROM documents
), k AS (
  SELECT DISTINCT h, ('0x' || h[1:16])::UHUGEINT::HUGEINT AS key0, ('0x' || h[17:20])::BIGINT % 1024 AS part FROM d
), walk AS (
  SELECT h, key0 AS key, -1::BIGINT AS spot, 0::BIGINT AS nxt FROM k
  UNION ALL
  SELECT h, nk, nxt, floor((nxt + 1) * (2147483648.0::DOUBLE / ((nk >> 33) + 1)::DOUBLE))::BIGINT
  FROM (SELECT h, nxt, (key * 2862933555777941757 + 1) % 18446744073709551616 AS nk FROM walk WHERE nxt < 40)
), placed AS (
  SELECT h, spot AS shard, CASE WHEN nxt = 40 THEN 40 ELSE spot END AS grown FROM walk WHERE nxt >= 40
), sized AS (
  SELECT doc_id, h, strlen(text) + 16 AS size,
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda x: ('0x' || x)::BIGINT)),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS crc FROM d, crc_table
)
SELECT s.doc_id, s.size::BIGINT AS size, s.crc::BIGINT AS text_crc32, 'key' AS law, p.shard::INT AS shard,
  row_number() OVER (PARTITION BY p.shard ORDER BY k.part, s.doc_id NULLS FIRST, s.size, s.crc) - 1 AS slot, p.grown::INT AS grown_shard
FROM sized s JOIN placed p USING (h) JOIN k USING (h)
"""
