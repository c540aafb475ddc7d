"""Chat formatting by perspective: every participant once as the assistant, the others as named users.

Only DataFrame functions. A row is a whole dialogue as one participant sees it. Where a turn's text ends
differs between participants only by how often the participant has spoken before, so two running sums over
the dialogue give every mask, and a turn adds to the mask of its own speaker alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

#: Roles that speak to all and are nobody's perspective.
NARRATORS = ("system",)
#: Name of a speaker without a role.
NOBODY = "unknown"
ASSISTANT, USER, NARRATOR, END = "<|assistant|>\n", "<|user name={}|>\n", "<|{}|>\n", "\n<|end|>\n"


def framed(form: str, name: Column) -> Column:
    left, right = form.split("{}")
    return F.concat(F.lit(left), name, F.lit(right))


def perspectives(
    df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    narrators: tuple[str, ...] = NARRATORS, stretch: int | None = None,
) -> DataFrame:
    """Per dialogue and participant: conv_id, perspective, n_turns, rendered, mask, n_masked.

    rendered holds the turns in order of turn, role and text, the participant's own as the assistant's.
    mask lists start:end in code points (end exclusive) of what the assistant writes, the end mark
    included. A mark inside a role or text is opened by ``< |`` instead of ``<|``. A turn that is repeated
    exactly is one turn; a null turn comes first, a null role is named unknown, a null text is empty. Of a
    row with a null conv_id nothing tells the dialogue: each is a dialogue of its own. A dialogue of
    narrators only has no perspective; an empty table gives an empty result.

    A dialogue is one row for each participant, so it has to fit into one (2 GB rendered). ``stretch`` cuts
    longer ones: rows are then per dialogue, participant and stretch of that many turn numbers (column
    stretch; null turns are one), each rendered from its own start.
    """
    safe = lambda c: F.replace(c, F.lit("<|"), F.lit("< |"))
    turns = df.select(
        F.col(f"`{conv_id}`").cast("bigint").alias("conv_id"), F.col(f"`{turn}`").cast("bigint").alias("turn"),
        safe(F.coalesce(F.col(f"`{role}`"), F.lit(NOBODY))).alias("role"), safe(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("text"),
    ).distinct()
    part = [] if stretch is None else ["stretch"]
    if stretch is not None:
        turns = turns.withColumn("stretch", F.expr(f"floor(turn / {int(stretch)})"))
    spoken = ~F.col("role").isin(*narrators)
    user, narrator = framed(USER, F.col("role")), framed(NARRATOR, F.col("role"))
    body = F.concat("text", F.lit(END))

    loose = turns.where(F.col("conv_id").isNull() & spoken).select(
        "conv_id", F.col("role").alias("perspective"), *part, F.lit(1).cast("bigint").alias("n_turns"), F.concat(F.lit(ASSISTANT), body).alias("rendered"),
        F.concat(F.lit(f"{len(ASSISTANT)}:"), (F.length(body) + len(ASSISTANT)).cast("string")).alias("mask"), F.length(body).cast("bigint").alias("n_masked"),
    )

    whole = ["conv_id", *part]
    order = ["turn", "role", "text"]
    so_far = W.Window.partitionBy(*whole).orderBy(*order).rowsBetween(W.Window.unboundedPreceding, 0)
    own_so_far = W.Window.partitionBy(*whole, "role").orderBy(*order).rowsBetween(W.Window.unboundedPreceding, 0)
    known = turns.where(F.col("conv_id").isNotNull()).withColumns({
        "head": F.when(spoken, user).otherwise(narrator), "body": body, "spoken": spoken,
    })
    # as if all were users; each earlier or present turn of the speaker is shorter or longer by what its two heads differ
    end = F.sum(F.length("head") + F.length("body")).over(so_far) - F.count("*").over(own_so_far) * (F.length("head") - len(ASSISTANT))
    placed = known.withColumn("end", end).withColumn("span", F.concat((F.col("end") - F.length("body")).cast("string"), F.lit(":"), F.col("end").cast("string")))
    dialogues = placed.groupBy(*whole).agg(F.sort_array(F.collect_list(F.struct(*order, "head", "body"))).alias("turns"))
    speakers = placed.where("spoken").groupBy(*whole, "role").agg(
        F.sort_array(F.collect_list(F.struct("end", "span"))).alias("spans"), F.sum(F.length("body")).cast("bigint").alias("n_masked")
    )
    if part:  # who speaks anywhere in the dialogue sees all of its stretches
        everyone = known.where("spoken").select("conv_id", "role").distinct()
        seats = dialogues.join(everyone, "conv_id").withColumn("at", F.coalesce("stretch", F.lit(-1)))
        marks = speakers.select("conv_id", "role", F.coalesce("stretch", F.lit(-1)).alias("at"), "spans", "n_masked")
        seen = seats.join(marks, ["conv_id", "at", "role"], "left")
    else:
        seen = dialogues.join(speakers, "conv_id")
    rendered = F.transform("turns", lambda t: F.concat(F.when(t["role"] == F.col("role"), F.lit(ASSISTANT)).otherwise(t["head"]), t["body"]))
    found = seen.select(
        "conv_id", F.col("role").alias("perspective"), *part, F.size("turns").cast("bigint").alias("n_turns"), F.array_join(rendered, "").alias("rendered"),
        F.coalesce(F.array_join("spans.span", ","), F.lit("")).alias("mask"), F.coalesce("n_masked", F.lit(0)).cast("bigint").alias("n_masked"),
    )
    return found.unionByName(loose)
