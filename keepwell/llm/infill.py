"""Fill-in-middle: a text is cut into units, and prefix, middle and suffix change places in one regular expression match.

A unit is a word with the white space before it, or white space at the end of the text: `regexp_count` gives their number n.
Two hashed numbers in 0..n are the cuts a <= b. The pattern of a row repeats the unit a times, then b - a times, and takes the
rest: one `regexp_replace` with it writes the output. All quantifiers are possessive. The matcher then repeats a group in a
loop, so its stack does not grow with the text, and nothing is ever tried again: a match reads the text once.

The markers hold no white space and no output is made of a text that holds one, so each stands in an output once, and
`restored` reads the parts back from output and form alone.

Forms: `plain` (the text as it is), `psm` (prefix, suffix, middle behind their markers), `spm` (suffix, prefix, middle).

Null texts are empty texts; empty texts and texts that hold a marker stay plain. A null id is hashed as an empty string. Rows are
taken one by one: repeated rows give equal results, an empty table gives an empty result, and of the input only the two named
columns are read, so other columns may have any name. A very long text costs its length, once to count and once to cut.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SPACE = r"[\x20\x09-\x0D]"
#: the two classes share no character, so possessive parts match what greedy ones would
UNIT = rf"(?:{SPACE}*+[^\x20\x09-\x0D]++|{SPACE}++)"


def draws(key: Column, seed: int, count: int = 4) -> list[Column]:
    """The first `count` 8-digit groups of the hex sha256 of `seed:key` as numbers."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(count)]


def filled_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 42, percent: int = 50,
                     percent_spm: int = 80) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output): `percent` of the texts change their form, `percent_spm` of these to spm."""
    units = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    units = units.select("id", "text", F.regexp_count("text", F.lit(UNIT)).cast("long").alias("n"),
                         *[h.alias(f"h{i}") for i, h in enumerate(draws(F.col("id"), seed), 1)])
    marked = F.lit(False)
    for marker in (PREFIX, SUFFIX, MIDDLE):
        marked = marked | F.contains("text", F.lit(marker))
    form = (F.when((F.col("n") == 0) | marked | (F.col("h3") % 100 >= percent), "plain")
            .when(F.col("h4") % 100 < percent_spm, "spm").otherwise("psm"))
    first, second = F.col("h1") % (F.col("n") + 1), F.col("h2") % (F.col("n") + 1)
    cut = units.select("id", "text", "n", form.alias("form"), F.least(first, second).alias("a"), F.greatest(first, second).alias("b"))
    pattern = F.format_string(rf"\A({UNIT}{{%d}}+)({UNIT}{{%d}}+)((?s:.*+))\z", "a", F.col("b") - F.col("a"))
    order = F.when(F.col("form") == "psm", f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2").otherwise(f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2")
    moved = cut.select("id", "n", "form", F.when(F.col("form") == "plain", F.col("text"))
                       .otherwise(F.regexp_replace("text", pattern, order)).alias("output"))
    return moved.select("id", "n", "form", *_lengths(), "output")


def _lengths() -> list[Column]:
    """Code points of prefix and middle, from where the markers stand in the output."""
    at = {marker: F.instr("output", marker) for marker in (PREFIX, SUFFIX, MIDDLE)}
    size = len(PREFIX)
    prefix = F.when(F.col("form") == "psm", at[SUFFIX] - 1 - size).when(F.col("form") == "spm", at[MIDDLE] - at[PREFIX] - size)
    middle = F.when(F.col("form") != "plain", F.length("output") - at[MIDDLE] - size + 1)
    return [prefix.cast("long").alias("prefix_chars"), middle.cast("long").alias("middle_chars")]


def restored(output: Column, form: Column) -> Column:
    """The text that `filled_in_middle` was given, rebuilt from output and form."""
    psm = F.regexp_replace(output, rf"(?s)\A{PREFIX}(.*?){SUFFIX}(.*?){MIDDLE}(.*+)\z", "$1$3$2")
    spm = F.regexp_replace(output, rf"(?s)\A{SUFFIX}(.*?){PREFIX}(.*?){MIDDLE}(.*+)\z", "$2$3$1")
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
