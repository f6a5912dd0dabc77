"""CIGAR strings as arrays of (op, len), their sums, and exons and splices from them, all inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PAIRS = "array<struct<start:long,end:long>>"


def cigar_ops(cigar: Column) -> Column:
    """An array of structs op, len; a null or ``*`` gives no operations."""
    parts = F.regexp_extract_all(F.coalesce(cigar, F.lit("")), F.lit(r"[0-9]+[MIDNSHPX=]"), F.lit(0))
    return F.transform(parts, lambda p: F.struct(F.right(p, F.lit(1)).alias("op"), F.substring(p, F.lit(1), F.length(p) - 1).cast("long").alias("len")))


def op_sum(ops: Column, letters: str) -> Column:
    return F.aggregate(ops, F.lit(0).cast("long"), lambda total, o: total + F.when(F.instr(F.lit(letters), o["op"]) > 0, o["len"]).otherwise(F.lit(0)))


def matched(ops: Column) -> Column:
    return op_sum(ops, "M=X" + "I")


def aligned(ops: Column) -> Column:
    return op_sum(ops, "M=XID")


def soft_clipped(ops: Column) -> Column:
    return op_sum(ops, "S")


def lengths(cigar: Column, letters: str) -> Column:
    """The sum of op_sum() right from the text, without operations in between."""
    found = F.regexp_extract_all(F.coalesce(cigar, F.lit("")), F.lit(f"([0-9]+)[{letters}]"), F.lit(1))
    return F.aggregate(found, F.lit(0).cast("long"), lambda total, x: total + x.cast("long"))


def has_exon(cigar: Column) -> Column:
    """Some M, D, = or X of a length over 0, so that exons_and_splices() finds an exon."""
    return F.coalesce(cigar, F.lit("")).rlike("[1-9][0-9]*[MD=X]")


def exons_and_splices(pos0: Column, ops: Column) -> Column:
    """A struct of exons and splices, 1-based and closed. M, D, = and X move along the reference; N ends an exon, if it is not empty,
    and is a splice; all other operations are passed over."""
    pos0 = pos0.cast("long")
    none = F.array().cast(PAIRS)
    pair = lambda a, b: F.array(F.struct(a.alias("start"), b.alias("end")))
    state = lambda pos, start, exons, splices: F.struct(pos.alias("pos"), start.alias("start"), exons.alias("exons"), splices.alias("splices"))
    close = lambda s: F.when(s["pos"] > s["start"], F.concat(s["exons"], pair(s["start"] + 1, s["pos"]))).otherwise(s["exons"])

    def step(s: Column, o: Column) -> Column:
        moved = s["pos"] + o["len"]
        return (
            F.when(o["op"] == "N", state(moved, moved, close(s), F.concat(s["splices"], pair(s["pos"] + 1, moved))))
            .when(F.instr(F.lit("MD=X"), o["op"]) > 0, state(moved, s["start"], s["exons"], s["splices"]))
            .otherwise(s)
        )

    return F.aggregate(ops, state(pos0, pos0, none, none), step, lambda s: F.struct(close(s).alias("exons"), s["splices"].alias("splices")))


def splice_pattern(splices: Column) -> Column:
    """``start-end`` of each splice, joined by colons; ``mono`` without splices."""
    text = F.array_join(F.transform(splices, lambda x: F.concat_ws("-", x["start"].cast("string"), x["end"].cast("string"))), ":")
    return F.when(F.size(splices) > 0, text).otherwise(F.lit("mono"))


def gaps(exons: Column) -> Column:
    """Splices between neighbouring sorted exons."""
    return F.transform(F.slice(exons, F.lit(2), F.greatest(F.size(exons) - 1, F.lit(0))), lambda x, i: F.struct((F.element_at(exons, i + 1)["end"] + 1).alias("start"), (x["start"] - 1).alias("end")))
