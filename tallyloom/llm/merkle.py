"""Merkle manifest of a dataset by butterfly exchange.

Every row is a leaf; the leaves of a branch, in order, form a tree of fanout
``FANOUT``, and the roots of the branches, in order, form the top tree. A node
is the digest of the digests of up to ``FANOUT`` consecutive nodes, as hex text.

Leaves are range-sorted and cut into aligned blocks of ``FANOUT ** BLOCK_LEVELS``
leaves. A block builds its lower levels alone. Then come the rounds of the
butterfly: in round r the blocks that differ only in digit r of their number
(base ``FANOUT``) swap their subtree roots, and each of them hashes the parent
for itself. So after the last round every block holds the root and all upper
siblings, and no pass goes down again. Where the last subtree of a round has
fewer blocks than its neighbours, its blocks also send to the partners that
have no counterpart in it; every group of an exchange has ``FANOUT`` roots at most.

A block is one packed row of its digests, bounded by the block size. A lost
executor costs a reread: leaves, blocks and each round are written tables.

Defined results: a null value is hashed as ``-``, an empty text as ``0:``; a
null branch is a branch of its own, before all others; rows of a branch with
equal ids are ordered by their leaf, rows without an id come first; an empty
table has no leaves and no root; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.ordering import numbered, range_sorted, ranked
from tallyloom.operators.sizing import broadcast_if_small
from tallyloom.session import scratch_table

FANOUT = 8
BLOCK_LEVELS = 4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<left:string,right:string>>"


def encoded(value: Column) -> Column:
    """Length-prefixed text of a value, ``-`` for null."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*map(encoded, values)).cast("binary"), 256)


def leaves(documents: DataFrame, claimed: Sequence[Column] | None = None, fields: Sequence[str] = FIELDS, branch: str = "lang", key: str = "doc_id") -> DataFrame:
    """(branch, id, leaf, claimed): ``claimed`` is the leaf of the values that somebody shows.

    ``branch`` is never null and sorts like the column, nulls first.
    """
    return documents.select(
        F.coalesce(F.concat(F.lit("="), F.col(branch).cast("string")), F.lit("")).alias("branch"),
        F.col(key).alias("id"),
        leaf([F.col(f) for f in fields]).alias("leaf"),
        (leaf(claimed) if claimed else F.lit(None).cast("string")).alias("claimed"),
    )


# --- blocks ---------------------------------------------------------------------


def digest(nodes: Sequence[str]) -> str:
    return hashlib.sha256("".join(nodes).encode()).hexdigest()


def block_levels(digests: list[str], alone: bool, height: int = BLOCK_LEVELS) -> list[list[str]]:
    """Nodes of every level: up to one node where the block is alone in its branch, else exactly ``height`` above the leaves."""
    out = [digests]
    while len(out[-1]) > 1 or (not alone and len(out) <= height):
        below = out[-1]
        out.append([digest(below[k : k + FANOUT]) for k in range(0, len(below), FANOUT)])
    return out


BLOCK = "branch string, block long, blocks long, root string, ids array<string>, leaves array<string>, claimed array<string>"


def _pack(height: int):
    def run(table: pa.Table) -> pa.Table:
        """One row of a block's leaves in order, with its subtree root."""
        table = table.sort_by("rank")
        blocks = -(-table["total"][0].as_py() // FANOUT**height)
        digests = table["leaf"].to_pylist()
        row = {
            "branch": table["branch"][0].as_py(), "block": table["block"][0].as_py(), "blocks": blocks,
            "root": block_levels(digests, blocks == 1, height)[-1][0],
            "ids": table["id"].to_pylist(), "leaves": digests, "claimed": table["claimed"].to_pylist(),
        }
        text = pa.list_(pa.string())
        schema = pa.schema([("branch", pa.string()), ("block", pa.int64()), ("blocks", pa.int64()), ("root", pa.string()), ("ids", text), ("leaves", text), ("claimed", text)])
        return pa.Table.from_pylist([row], schema)

    return run


def packed(leaves: DataFrame, label: str, height: int = BLOCK_LEVELS) -> DataFrame:
    """Aligned blocks of ``FANOUT ** height`` leaves of every branch."""
    rows = numbered(leaves, f"{label}-leaves")
    ordered = range_sorted(rows, [F.col(c).asc_nulls_first() for c in ("branch", "id", "leaf", "row")], f"{label}-sorted")
    placed = ranked(ordered, ["branch"]).select(
        "branch", F.floor(F.col("rank") / FANOUT**height).alias("block"), "rank", "total", F.col("id").cast("string").alias("id"), "leaf", "claimed"
    )
    return scratch_table(placed.groupBy("branch", "block").applyInArrow(_pack(height), BLOCK), f"{label}-blocks")


# --- butterfly --------------------------------------------------------------------


def _round(state: DataFrame, stride: int) -> DataFrame:
    """One exchange: blocks that differ in one digit swap roots and hash their parent."""
    low, node = F.col("block") % stride, F.floor(F.col("block") / stride)
    # Blocks of this subtree; only the last one of a branch has fewer than ``stride``.
    have = F.least(F.lit(stride), F.col("blocks") - node * stride)
    alone = node % FANOUT == 0
    partners = F.when((have == stride) | alone, F.array(low)).otherwise(F.sequence(low, F.lit(stride - 1).cast("long"), have))
    sent = state.select(
        "branch", "block", "blocks", "root", "path", low.alias("own"),
        F.floor(F.col("block") / (stride * FANOUT)).alias("group"), (node % FANOUT).alias("digit"), F.explode(partners).alias("low"),
    )
    mine = F.when(F.col("own") == F.col("low"), F.struct("block", "blocks", "path"))
    met = sent.groupBy("branch", "group", "low").agg(F.sort_array(F.collect_list(F.struct("digit", "root", mine.alias("mine")))).alias("members"))
    parent = F.sha2(F.concat_ws("", F.transform("members", lambda m: m["root"])).cast("binary"), 256)
    swapped = met.select("branch", "members", parent.alias("root"), F.explode(F.filter("members", lambda m: m["mine"].isNotNull())).alias("m"))

    def side(keep):
        return F.concat_ws("", F.transform(F.filter("members", keep), lambda m: m["root"]))

    step = F.struct(side(lambda m: m["digit"] < F.col("m.digit")).alias("left"), side(lambda m: m["digit"] > F.col("m.digit")).alias("right"))
    return swapped.select("branch", "m.mine.block", "m.mine.blocks", "root", F.concat("m.mine.path", F.array(step)).alias("path"))


def butterfly(blocks: DataFrame) -> DataFrame:
    """(branch, block, blocks, root, path): the root of the branch and the siblings above each block."""
    state = scratch_table(blocks.select("branch", "block", "blocks", "root", F.array().cast(PATH).alias("path")), "round")
    most = state.agg(F.max("blocks")).first()[0] or 0
    stride = 1
    while stride < most:
        active = F.col("blocks") > stride
        state = scratch_table(_round(state.where(active), stride).unionByName(state.where(~active)), "round")
        stride *= FANOUT
    return state


# --- proofs -----------------------------------------------------------------------


def _siblings(depths: list[list[str]], at: int) -> list[tuple[str, str]]:
    """(left, right) siblings of a leaf on every level that is hashed further."""
    out = []
    for nodes in depths[:-1]:
        first = at - at % FANOUT
        out.append(("".join(nodes[first:at]), "".join(nodes[at + 1 : first + FANOUT])))
        at //= FANOUT
    return out


def fold(node: str, path: Sequence[tuple[str, str]]) -> str:
    """The root that a leaf and its siblings lead to."""
    for left, right in path:
        node = digest([left, node, right])
    return node


PROOF = "id string, leaf string, subroot string, root string, proof array<struct<left:string,right:string>>, folded string"
CHECK = "id string, leaf string, subroot string, root string, proof_sha256 string, folded string"


def _proofs(whole: bool, height: int):
    """Per leaf its proof (or the proof's digest) and the root that the claimed leaf folds to."""

    def run(batches):
        for batch in batches:
            for block in batch.to_pylist():
                depths = block_levels(block["leaves"], block["blocks"] == 1, height)
                upper = [(s["left"], s["right"]) for s in block["path"]]
                tail = "".join(left + right for left, right in upper)
                out = []
                for at, (one, shown) in enumerate(zip(block["leaves"], block["claimed"])):
                    lower = _siblings(depths, at)
                    folded = fold(one if shown is None else shown, lower + upper)
                    row = {"id": block["ids"][at], "leaf": one, "subroot": block["subroot"], "root": block["top"], "folded": folded}
                    if whole:
                        row["proof"] = [{"left": left, "right": right} for left, right in lower + upper]
                    else:
                        row["proof_sha256"] = hashlib.sha256(("".join(left + right for left, right in lower) + tail).encode()).hexdigest()
                    out.append(row)
                side = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
                proof = ("proof", side) if whole else ("proof_sha256", pa.string())
                schema = pa.schema([("id", pa.string()), ("leaf", pa.string()), ("subroot", pa.string()), ("root", pa.string()), proof, ("folded", pa.string())])
                yield pa.RecordBatch.from_pylist(out, schema)

    return run


@dataclass(frozen=True)
class Manifest:
    """``blocks``: packed leaves; ``upper``: (branch, block, subroot, top, path) with all siblings above a block."""

    blocks: DataFrame
    upper: DataFrame
    height: int

    def roots(self) -> DataFrame:
        """(branch, subroot, root)."""
        return self.upper.where("block = 0").select("branch", "subroot", F.col("top").alias("root"))

    def _joined(self) -> DataFrame:
        return self.blocks.select("branch", "block", "blocks", "ids", "leaves", "claimed").join(broadcast_if_small(self.upper), ["branch", "block"])

    def proofs(self) -> DataFrame:
        """Per leaf its siblings of every level, and ``folded``, what the claimed leaf leads to by them."""
        return self._joined().mapInArrow(_proofs(True, self.height), PROOF)

    def checks(self) -> DataFrame:
        """As ``proofs``, with the digest of the siblings in place of them."""
        return self._joined().mapInArrow(_proofs(False, self.height), CHECK)


def manifest(leaves: DataFrame, height: int = BLOCK_LEVELS) -> Manifest:
    """The trees over ``leaves`` and the upper siblings of every block of ``FANOUT ** height`` leaves."""
    blocks = packed(leaves, "branch", height)
    state = butterfly(blocks)
    # The top tree goes the same way, with the roots of the branches as leaves.
    firsts = state.where("block = 0").select(F.lit("").alias("branch"), F.col("branch").alias("id"), F.col("root").alias("leaf"), F.lit(None).cast("string").alias("claimed"))
    top = packed(firsts, "top", height)
    tops = Manifest(top, butterfly(top).select("branch", "block", F.lit("").alias("subroot"), F.col("root").alias("top"), "path"), height)
    above = tops.proofs().select(F.col("id").alias("branch"), F.col("leaf").alias("subroot"), F.col("root").alias("top"), F.col("proof").alias("above"))
    above = scratch_table(above, "above")
    upper = state.select("branch", "block", "path").join(broadcast_if_small(above), "branch")
    return Manifest(blocks, scratch_table(upper.select("branch", "block", "subroot", "top", F.concat("path", "above").alias("path")), "upper"), height)


_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def tampered(documents: DataFrame, one_in: int = 3) -> list[Column]:
    """Values of a copy in which some rows have their text's A-Z lower-cased."""
    chosen = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % one_in == 0, F.lit(False))
    text = F.when(chosen, F.translate("text", _CAPITALS, _CAPITALS.lower())).otherwise(F.col("text"))
    return [text if f == "text" else F.col(f) for f in FIELDS]
