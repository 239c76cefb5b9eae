"""First-writer ownership of hook tokens and hook ids.

The owner of a key is its earliest claim. Owners come from one aggregation
(``min_by`` with partial results), not from a sorted window, so a token claimed
by a third of all hooks is no task of its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed values in milliseconds: one call between services at most, its attempts and the delay between them, and what a delivery's lease has beyond its call.
CALL_MS, CALL_ATTEMPTS, CALL_DELAY_MS, LEASE_GRACE_MS = 300_000, 3, 900, 30_000
#: Fixed values in milliseconds: how long a hook claim is held, and the largest lead of a catalog publication.
HOOK_CLAIM_MS, PUBLICATION_MS = 2_101_800, 1_200_900
#: Milliseconds for which what was admitted before an expiry may still write: a call with its repeats, a publication after it, a queue's lease, a hook's claim.
HORIZONS = {
    "call": CALL_ATTEMPTS * CALL_MS + CALL_DELAY_MS,
    "publication": (CALL_ATTEMPTS + 1) * CALL_MS + CALL_DELAY_MS,
    "lease": CALL_MS + LEASE_GRACE_MS,
    "claim": (2 * CALL_ATTEMPTS + 1) * CALL_MS + 2 * CALL_DELAY_MS,
}
#: Which horizon an expiry's fence has to outlive, by what it fences.
FENCES = {"catalog": "publication", "queue": "lease", "hook": "claim"}


def fence_ends(expired_ms: Column, kind: Column) -> Column:
    """When a fence of an expired run may go: nothing admitted before can write any more. Null for an unknown kind."""
    ends = F.lit(None).cast("long")
    for name, horizon in FENCES.items():
        ends = F.when(kind == name, expired_ms + HORIZONS[horizon]).otherwise(ends)
    return ends


def owners(claims: DataFrame, key: str, order: Sequence[str], carry: Sequence[str]) -> DataFrame:
    """(key, carried columns of its first claim in ``order``, n_claims)."""
    first = F.min_by(F.struct(*carry), F.struct(*order))
    return claims.groupBy(key).agg(first.alias("o"), F.count(F.lit(1)).alias("n_claims")).select(key, "o.*", "n_claims")


def admit(claims: DataFrame, key: str, order: Sequence[str], owner: str) -> DataFrame:
    """Claims with ``holder`` (owner of the key) and ``admitted``: the claim's owner holds the key."""
    first = claims.groupBy(key).agg(F.min_by(owner, F.struct(*order)).alias("holder"))
    return claims.join(first, key).withColumn("admitted", F.col("holder") == F.col(owner))


def conflicts(claims: DataFrame, key: str, order: Sequence[str], owner: str) -> DataFrame:
    """Claims on a key that another owner holds; each becomes a hook_conflict naming the holder."""
    return admit(claims, key, order, owner).where(~F.col("admitted")).drop("admitted")


def two_domain_admission(claims: DataFrame, token: str, hook: str, order: Sequence[str], owner: str) -> DataFrame:
    """Token first, then hook id among the claims that won their token; ``outcome`` says where a claim stopped.

    A claim that holds its token but loses its id releases the token claim.
    """
    first = admit(claims, token, order, owner)
    winners = first.where("admitted").groupBy(hook).agg(F.min_by(owner, F.struct(*order)).alias("id_holder"))
    joined = first.join(winners, hook, "left")
    outcome = (
        F.when(~F.col("admitted"), "token_conflict").when(F.col("id_holder") != F.col(owner), "id_conflict").otherwise("published")
    )
    return joined.withColumn("outcome", outcome).drop("admitted", "id_holder")


def claim_state(reserved_ms: Column, now_ms: Column, lease_ms: int = HOOK_CLAIM_MS) -> Column:
    """A claim is live until its lease is over, then its key may be claimed again."""
    return F.when(reserved_ms + lease_ms > now_ms, "live").otherwise("expired")


def publication_allowed(expires_ms: Column, now_ms: Column) -> Column:
    """A catalog row is stored only within its publication lease: now < expires <= now + the largest lead."""
    return (expires_ms > now_ms) & (expires_ms <= now_ms + PUBLICATION_MS)


def resolve(claims: DataFrame, hooks: DataFrame, tokens: DataFrame, expired: DataFrame, run: str = "run_id") -> DataFrame:
    """What became of claims (run, hook_id, token) whose answer was lost: ``state`` is committed, cancelled or expired.

    Committed if both the hook and its token are there; an expired run never
    writes a fence, any other claim is cancelled by one.
    """
    out = claims
    for name, df, keys in (("__hook", hooks, [run, "hook_id"]), ("__token", tokens, [run, "token"]), ("__gone", expired, [run])):
        out = out.join(df.select(*keys, F.lit(True).alias(name)).distinct(), keys, "left")
    state = F.when(F.col("__hook") & F.col("__token"), "committed").when(F.col("__gone"), "expired").otherwise("cancelled")
    return out.withColumn("state", state).drop("__hook", "__token", "__gone")


def release_counts(claims: DataFrame, released: DataFrame, keys: Sequence[str], shard: Column) -> DataFrame:
    """(shard, n_released, n_left) of a release, and their sums over all shards in the row with a null shard."""
    mark = released.select(*keys, F.lit(True).alias("__gone")).distinct()
    joined = claims.withColumn("shard", shard).join(mark, list(keys), "left")
    gone = F.col("__gone").isNotNull()
    return joined.rollup("shard").agg(F.count(F.when(gone, 1)).alias("n_released"), F.count(F.when(~gone, 1)).alias("n_left"))


def release(claims: DataFrame, released: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Claims without those released: exact match of owner and claim."""
    return claims.join(released.select(*keys).distinct(), list(keys), "left_anti")
