"""Chat formatting with rotating perspectives (operator 9).

Every participant of a conversation in turn becomes the assistant: that speaker's turns are
rendered as the assistant's and carry loss, the others' as named users' and carry none. System
turns (role ``system``) are the setting: they are rendered in every perspective, never learnt, and
no participant. Turns are cut into segments of :data:`SEGMENT` turn numbers, and a segment with more
rows than that (NULL or tied turn numbers) into parts of as many rows, so a conversation of any
length becomes rows of at most twice as many turns, and no group holds a whole conversation. Every
segment and part begins with the last :data:`SEGMENT` system turns of the ones before (all, if
fewer); other earlier turns are not repeated (the overlap is the setting only), so output grows with
the turns. System turns are numbered along their conversation by counts per range, and a segment
meets those before it in blocks of as many numbers. Everything is DataFrame expressions; a hot
conversation is split by segment and part, and its join by AQE.

Output: ``conv_id, perspective, segment, n_turns, text, mask, n_masked, part, lead, start``.
``n_turns`` counts the segment's own turns. ``mask`` has the character ranges ``start-end`` (end
exclusive, comma-joined) of what the assistant says, closing marker included; ``n_masked`` counts
these characters. ``lead`` is the length of the repeated system turns, ``start`` the offset of what
follows them in the whole dialogue: the texts without their lead, by segment and part, join to it.
The registered query has the columns up to ``part``.

Defined cases: a NULL role is the participant ``unknown``; a NULL text is empty; a NULL turn
comes first, in segment -1; rows equal in all four columns count once; equal turns are ordered by
role, then text; control markers inside a text are broken by a space, so no text can open a turn; a
NULL ``conv_id`` names no conversation and its rows are left out; without participants (system
turns only) there are no rows; where a participant is silent, its row has an empty mask.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.frames import pick, store

SEGMENT = 64
SYSTEM = "system"


def _numbered(said: DataFrame, segment: int) -> DataFrame:
    """``said`` with the part of its segment: row numbers over (turn, role, text), from counts per range.

    Rows are dealt by ranges of the whole order, so a segment's rows may lie in many partitions; a
    row's number is its number in its partition plus the counts of the partitions before.
    """
    group = ["conv_id", "segment"]
    order = [F.col(c).asc_nulls_first() for c in ("turn", "role", "text")]
    dealt = store(said.repartitionByRange(*group, *order).withColumn("range", F.spark_partition_id()), "turns")
    here = dealt.withColumn("k", F.row_number().over(Window.partitionBy(*group, "range").orderBy(*order)))
    before = Window.partitionBy(*group).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = dealt.groupBy(*group, "range").agg(F.count("*").alias("n"))
    earlier = ranges.select(*group, "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    return (here.join(earlier, [*group, "range"])
            .withColumn("part", F.floor((F.col("k") + F.col("earlier") - 1) / segment).cast("long")).drop("range", "k", "earlier"))


def _before(frame: DataFrame, group: list[str], order: list[str], value: str) -> DataFrame:
    """``frame`` plus ``before``: the sum of ``value`` over its group's rows before, in ``order``.

    Rows are dealt by ranges of the whole order: a row's sum is the one in its partition plus those of
    the partitions before, so no task holds a whole group.
    """
    dealt = store(frame.repartitionByRange(*group, *order).withColumn("range", F.spark_partition_id()), "running")
    here = Window.partitionBy(*group, "range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    ahead = Window.partitionBy(*group).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    zero = lambda c: F.coalesce(c, F.lit(0))
    earlier = (dealt.groupBy(*group, "range").agg(F.sum(value).alias("n"))
               .select(*group, "range", zero(F.sum("n").over(ahead)).alias("earlier")))
    return (dealt.withColumn("here", zero(F.sum(value).over(here))).join(earlier, [*group, "range"])
            .withColumn("before", F.col("here") + F.col("earlier")).drop("range", "here", "earlier"))


def _settings(said: DataFrame, segment: int) -> DataFrame:
    """For every place the last ``segment`` system turns of its conversation's places before."""
    place = ["conv_id", "segment", "part"]
    places = said.groupBy(*place).agg(F.sum((F.col("role") == SYSTEM).cast("long")).alias("n_system"))
    # conversations of one place, or without a system turn, have no setting to repeat
    long = (places.groupBy("conv_id").agg(F.count("*").alias("n"), F.sum("n_system").alias("system"))
            .where("n > 1 AND system > 0").select("conv_id"))
    places = store(_before(places.join(long, "conv_id", "left_semi"), ["conv_id"], ["segment", "part"], "n_system"), "places")
    inside = Window.partitionBy(*place).orderBy(*[F.col(c).asc_nulls_first() for c in ("turn", "role", "text")])
    system = (said.where(F.col("role") == SYSTEM).join(places.where("n_system > 0"), place)
              .withColumn("number", F.col("before") + F.row_number().over(inside) - 1)
              .select("conv_id", "turn", "role", "text", "number", F.floor(F.col("number") / segment).alias("block")))
    # the last ``segment`` numbers before a place lie in its own block and the one before
    last = F.floor(F.col("before") / segment)
    wanted = places.where("before > 0").select(*place, "before", F.explode(F.array(last - 1, last)).alias("block"))
    return (wanted.join(system, ["conv_id", "block"]).where((F.col("number") < F.col("before")) & (F.col("number") >= F.col("before") - segment))
            .select(*place, "turn", "role", "text", F.lit(False).alias("own")))


def rotate(turns: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """One row per conversation, participant, segment and part; see the module."""
    raw = (pick(turns, conv_id="long", turn="long", role="string", text="string").where("conv_id IS NOT NULL")
           .select("conv_id", "turn", F.coalesce("role", F.lit("unknown")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
                   F.coalesce(F.floor(F.col("turn") / segment), F.lit(-1)).cast("long").alias("segment")))
    speakers = raw.where(F.col("role") != SYSTEM).select("conv_id", F.col("role").alias("perspective")).distinct()
    # only segments with more rows than turn numbers are numbered; their keys are few and stored
    group, place = ["conv_id", "segment"], ["conv_id", "segment", "part"]
    large = store(raw.groupBy(*group).count().where(F.col("count") > segment).select(*group), "large")
    small = raw.join(large, group, "left_anti").withColumn("part", F.lit(0).cast("long"))
    numbered = store(_numbered(raw.join(large, group, "left_semi").distinct(), segment), "numbered")
    said = small.distinct().unionByName(numbered)
    # the setting: the latest system turns of the places before are repeated at the head of every later one
    repeated = _settings(said, segment)
    said = said.select(*place, "turn", "role", "text", F.lit(True).alias("own")).unionByName(repeated)
    safe = lambda c: F.regexp_replace(c, r"<\|", "< |")
    head = (F.when(F.col("role") == SYSTEM, F.lit("<|im_start|>system\n"))
            .when(F.col("role") == F.col("perspective"), F.lit("<|im_start|>assistant\n"))
            .otherwise(F.concat(F.lit("<|im_start|>user name="), safe("role"), F.lit("\n"))))
    mine = (F.col("role") != SYSTEM) & (F.col("role") == F.col("perspective"))
    rendered = (said.join(speakers, "conv_id")
                .select("conv_id", "perspective", "segment", "part",
                        F.struct("own", "turn", "role", "text", head.alias("head"), F.concat(safe("text"), F.lit("<|im_end|>")).alias("body"), mine.alias("mine")).alias("t")))
    grouped = rendered.groupBy("conv_id", "perspective", "segment", "part").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    # offsets: where each turn's body starts, from the running length of what is before it
    length = lambda t: F.char_length(t["head"]) + F.char_length(t["body"]) + 1
    start = F.struct(F.lit(0).alias("at"), F.expr("CAST(array() AS array<struct<s: int, e: int>>)").alias("spans"))

    def step(acc, t):
        body = acc["at"] + F.char_length(t["head"])
        span = F.array(F.struct(body.alias("s"), (body + F.char_length(t["body"])).alias("e")))
        return F.struct((acc["at"] + length(t)).alias("at"), F.when(t["mine"], F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    whole = F.array_join(F.transform("ts", lambda t: F.concat(t["head"], t["body"], F.lit("\n"))), "")
    lead = F.aggregate(F.filter("ts", lambda t: ~t["own"]), F.lit(0), lambda n, t: n + length(t))
    after = Window.partitionBy("conv_id", "perspective").orderBy("segment", "part").rowsBetween(Window.unboundedPreceding, -1)
    return (grouped.withColumn("spans", F.aggregate("ts", start, step)["spans"])
            .select("conv_id", "perspective", "segment", F.size(F.filter("ts", lambda t: t["own"])).cast("long").alias("n_turns"), whole.alias("text"),
                    F.array_join(F.transform("spans", lambda s: F.concat(s["s"].cast("string"), F.lit("-"), s["e"].cast("string"))), ",").alias("mask"),
                    F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["e"] - s["s"]).alias("n_masked"),
                    "part", lead.cast("long").alias("lead"))
            .withColumn("start", F.coalesce(F.sum(F.char_length("text") - F.col("lead")).over(after), F.lit(0)).cast("long")))
