"""Names by content: canonical JSON, joined keys, digests, object keys, shards and samples."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def canonical_json(**fields: Column) -> Column:
    """Sorted keys, no blanks, nulls kept."""
    struct = F.struct(*[fields[k].alias(k) for k in sorted(fields)])
    return F.to_json(struct, {"ignoreNullFields": "false"})


def content_hash(**fields: Column) -> Column:
    return F.sha2(canonical_json(**fields), 256)


def joined_hash(sep: str, *cols: Column) -> Column:
    """sha256 of the columns joined by ``sep``; null counts as empty."""
    return F.sha2(F.concat_ws(sep, *[F.coalesce(c.cast("string"), F.lit("")) for c in cols]), 256)


def digest(lines: Column) -> Column:
    """Aggregate: sha256 of the group's sorted lines."""
    return F.sha2(F.array_join(F.sort_array(F.collect_list(lines)), "\n"), 256)


def object_key(prefix: str, source: Column, collection: Column, sha: Column, extension: Column) -> Column:
    """prefix/source/collection/first two of sha/sha.extension, or null where a part does not fit."""
    fits = sha.rlike("^[0-9a-f]{64}$") & extension.rlike("^[a-z0-9]+$") & collection.rlike("^[a-z0-9-]+$")
    return F.when(fits, F.concat_ws("/", F.lit(prefix), source, collection, F.substring(sha, 1, 2), F.concat_ws(".", sha, extension)))


def hash_shard(sha: Column, n: int) -> Column:
    """The first 64 bits of a hex digest, modulo n."""
    return (F.conv(F.substring(sha, 1, 16), 16, 10).cast("decimal(20,0)") % n).cast("int")


def in_hash_sample(sha: Column, rate: float) -> Column:
    """Whether the digest lies in the lowest ``rate`` of all digests: hex of one length compares as numbers do."""
    if rate >= 1.0:
        return F.lit(True)
    return sha <= F.lit(f"{int(rate * (2**256 - 1)):064x}")
