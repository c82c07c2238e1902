"""Preference formatting: paired, masked completions over one shared prompt.

The chosen and the rejected conversation of a pair are aligned turn by turn,
by grouping on (pair, turn); the smallest turn that differs ends their longest
common prefix. Turns before it are rendered once, from the chosen side, as the
prompt; the others become the two completions. A mask names, run by run, how
many characters belong to a turn and whether they are trained on: assistant
turns of a completion are, everything else is not.

A pair gives one row. Its turns are put together in two steps: blocks of
``BLOCK_TURNS`` turn numbers become strings first, spread over tasks, and only
these strings meet in the pair's row. With ``split_rows`` a row covers one
block instead (``part`` counts them from 0), for conversations that should not
be one row.

Edge cases: exactly repeated turn rows count once; several messages of one
turn are rendered in order of role and text. A null text is empty, a null
role is ``unknown``, a null turn is turn -1; rows with a null conversation
form a pair of their own. A conversation without its partner has an empty
prompt and a null other side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_TURNS = 512


def rendered(role: Column, text: Column) -> Column:
    return F.concat(F.lit("<|"), role, F.lit("|>\n"), text, F.lit("<|end|>\n"))


def format_preferences(turns: DataFrame, pair: Column, is_chosen: Column, turn_col: str = "turn", role_col: str = "role",
                       text_col: str = "text", block_turns: int = BLOCK_TURNS, split_rows: bool = False) -> DataFrame:
    """``pair``: pair id of a turn row; ``is_chosen``: whether it belongs to the chosen side.

    Returns ``pair_id``, ``prompt_turns``, ``prompt``, ``chosen``,
    ``rejected``, ``chosen_mask``, ``rejected_mask``, and with ``split_rows``
    ``part``; a mask is ``chars:0|1`` runs joined by commas.
    """
    turn = F.coalesce(F.col(turn_col), F.lit(-1)).cast("long")
    base = turns.select(
        F.coalesce(pair, F.lit(0)).alias("pair"), pair.isNull().alias("none"), F.floor(turn / F.lit(block_turns)).cast("long").alias("part"),
        turn.alias("turn"), is_chosen.alias("side"),
        F.struct(F.coalesce(F.col(role_col), F.lit("unknown")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).alias("m"))

    def messages(side: Column) -> Column:
        own = F.sort_array(F.collect_set(F.when(side, F.col("m"))))
        return F.when(F.size(own) > 0, own)

    # repeated rows are dropped before the first shuffle; texts move here and once more, to the rows of the result
    key = ["pair", "none", "part"]
    said = base.groupBy(*key, "turn").agg(messages(F.col("side")).alias("c"), messages(~F.col("side")).alias("r"))
    ends = said.groupBy(*key).agg(F.min(F.when(~F.col("c").eqNullSafe(F.col("r")), F.col("turn"))).alias("cut"),
                                  F.count("c").alias("nc"), F.count("r").alias("nr"))
    whole = ends.groupBy("pair", "none").agg(F.min("cut").alias("cut"), F.sum("nc").alias("nc"), F.sum("nr").alias("nr"))
    rows = said.join(ends.select(*key).join(whole, ["pair", "none"]), key)
    shared = F.col("cut").isNull() | (F.col("turn") < F.col("cut"))

    def text_of(m: Column) -> Column:
        return F.array_join(F.transform(m, lambda x: rendered(x["role"], x["text"])), "")

    def mask_of(m: Column) -> Column:
        return F.array_join(F.transform(m, lambda x: F.concat(
            F.length(rendered(x["role"], x["text"])).cast("string"), F.when(x["role"] == "assistant", F.lit(":1")).otherwise(F.lit(":0")))), ",")

    def joined(name: str, sep: str = "") -> Column:
        full = F.filter("all", lambda x: x[name].isNotNull())
        return F.array_join(F.transform(full, lambda x: x[name]), sep)

    own = rows.select(*key, "nc", "nr", F.struct(
        "turn", F.when(shared, text_of(F.col("c"))).alias("p"),
        F.when(~shared, text_of(F.col("c"))).alias("c"), F.when(~shared, text_of(F.col("r"))).alias("r"),
        F.when(~shared, mask_of(F.col("c"))).alias("cm"), F.when(~shared, mask_of(F.col("r"))).alias("rm")).alias("row"))
    lines = own.groupBy(*key).agg(F.sort_array(F.collect_list("row")).alias("all"), F.max("nc").alias("nc"), F.max("nr").alias("nr"))
    texts = {"p": "", "c": "", "r": "", "cm": ",", "rm": ","}
    lines = lines.select(*key, "nc", "nr", F.size(F.filter("all", lambda x: x["p"].isNotNull())).cast("long").alias("prompt_turns"),
                         *[joined(name, sep).alias(name) for name, sep in texts.items()])
    if not split_rows:
        lines = lines.groupBy("pair", "none").agg(F.max("nc").alias("nc"), F.max("nr").alias("nr"), F.sum("prompt_turns").alias("prompt_turns"),
                                                  F.sort_array(F.collect_list(F.struct("part", *texts))).alias("all"))

        def whole_text(name: str, sep: str) -> Column:
            return F.array_join(F.filter(F.transform("all", lambda x: x[name]), lambda x: x != ""), sep)
        lines = lines.select("pair", "none", "nc", "nr", "prompt_turns", *[whole_text(name, sep).alias(name) for name, sep in texts.items()])
    has_c, has_r = F.col("nc") > 0, F.col("nr") > 0
    return lines.select(
        F.when(~F.col("none"), F.col("pair")).alias("pair_id"), *(["part"] if split_rows else []), "prompt_turns", F.col("p").alias("prompt"),
        F.when(has_c, F.col("c")).alias("chosen"), F.when(has_r, F.col("r")).alias("rejected"),
        F.when(has_c, F.col("cm")).alias("chosen_mask"), F.when(has_r, F.col("rm")).alias("rejected_mask"))
