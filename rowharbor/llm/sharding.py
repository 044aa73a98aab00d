"""Sharding by a weighted hash tree of regions, racks and shards."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowharbor.llm.common import materialise, running_before, text_of, unit_interval


RESULT = ("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


@dataclass(frozen=True)
class Node:
    """A shard (``shard`` set) or a region or rack with children.

    A node weighs what its children weigh together; another weight scales all that is below it.
    """

    name: str
    weight: float = 1.0
    children: tuple[Node, ...] = ()
    shard: int | None = None


def even_tree(shards: int, regions: int = 2, racks: int = 2) -> Node:
    """Shards dealt over regions and racks in turn; a node weighs as many shards as it holds."""
    places: dict[tuple[int, int], list[int]] = {}
    for shard in range(shards):
        region = shard % regions
        places.setdefault((region, shard // regions % racks), []).append(shard)
    above = []
    for region in range(regions):
        below = []
        for rack in range(racks):
            own = places.get((region, rack), [])
            name = f"region{region}/rack{rack}"
            if own:
                leaves = tuple(Node(f"{name}/shard{s}", 1.0, (), s) for s in own)
                below.append(Node(name, float(len(own)), leaves))
        if below:
            above.append(Node(f"region{region}", sum(n.weight for n in below), tuple(below)))
    return Node("root", sum(n.weight for n in above), tuple(above))


def _draw(key: Column, name: str, weight: float) -> Column:
    """An exponential draw of rate ``weight`` that depends on the key and the node's name only."""
    u = unit_interval(F.md5(F.concat(key, F.lit(f"/{name}"))))
    return -F.log(u) / F.lit(float(weight))


def _winner(key: Column, node: Node, scale: float = 1.0) -> Column:
    """The least draw below a node, with its shard."""
    if node.shard is not None:
        return F.struct(_draw(key, node.name, node.weight * scale).alias("draw"), F.lit(node.shard).alias("shard"))
    below = scale * node.weight / sum(child.weight for child in node.children)
    winners = [_winner(key, child, below) for child in node.children]
    return F.least(*winners) if len(winners) > 1 else winners[0]


def place(key: Column, tree: Node) -> Column:
    """The shard of a key.

    At each level the child with the least weighted draw wins, so a child gets its weight's
    share. A node's draw is the least of the draws of its shards, which is again a draw of their joint weight: a
    shard that is added, or whose weight rises, wins keys for itself only, and one that goes or weighs
    less leaves only its own keys to others. Scaling a region or rack moves keys into it or out
    of it and none between others or within it.
    """
    return _winner(key, tree)["shard"]


def shard_documents(docs: DataFrame, shards: int = 16, keep: Sequence[str] = ()) -> DataFrame:
    """Put documents into shards by the law ``key``: id and number of shards alone decide.

    Returns ``doc_id, size, text_crc32, law, shard, slot, grown_shard``, one row per row of
    ``docs``. ``size`` is the UTF-8 length plus 1, ``slot`` the place in the shard, gapless from 0
    in the order of the MD5 of id and ``text_crc32``; ``grown_shard`` is the shard that the same law
    gives with one more shard. Null text counts as empty, rows without id share one shard, rows that repeat an id share
    its shard. Slots come from counts of small hash ranges, so a shard of any
    size is numbered by many tasks. Columns of ``docs`` named in ``keep`` are carried along, unless
    they have the name of a result column.
    """
    keep = [c for c in keep if c not in RESULT]
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    crc = F.crc32(text_of().cast("binary")).cast("bigint")
    placed = materialise(
        docs.select(
            "doc_id",
            (F.octet_length(text_of()).cast("bigint") + 1).alias("size"),
            crc.alias("text_crc32"),
            F.lit("key").alias("law"),
            place(key, even_tree(shards)).cast("int").alias("shard"),
            place(key, even_tree(shards + 1)).cast("int").alias("grown_shard"),
            F.md5(F.concat(key, F.lit("/"), crc.cast("string"))).alias("_key"),
            F.lit(1).cast("bigint").alias("_one"),
            *[F.col(f"`{c}`").alias(f"_kept_{i}") for i, c in enumerate(keep)],
        ),
        "shards",
    )
    numbered = running_before(placed, "shard", "_key", "_one", ["doc_id", "size", "text_crc32"], "slots")
    return numbered.select("doc_id", "size", "text_crc32", "law", "shard",
                           F.col("_before").cast("bigint").alias("slot"), "grown_shard",
                           *[F.col(f"_kept_{i}").alias(c) for i, c in enumerate(keep)])
