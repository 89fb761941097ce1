"""Fill-in-middle examples: each text is cut in three, and the middle moves to the end.

The cuts are found by markers. A delimiter is escaped in the text, appended after each unit, and counted; the parts are then what lies before and between
the delimiters of two ranks, with markers taken out and the escapes undone. All of it are built-in expressions of one row: no shuffle, no Python.

A null text is an empty one, and a text without units is plain. A null id draws like the empty string. Equal rows give equal rows. Texts of any length are
whole; one holds some copies of itself in memory. Other columns stay, those named like a result's go.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The delimiter of units and what escapes it: control characters that texts hardly hold. Texts that do are as right, only longer on the way.
ESCAPE, DELIMITER = "\x1e", "\x1f"
CODE_POINT = "(?s)."
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
RESULT = ["n", "form", "prefix", "middle", "suffix", "output"]


def escaped(text: Column) -> Column:
    """text without a delimiter: the escape becomes escape and `e`, the delimiter escape and `d`."""
    return F.replace(F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE + "e")), F.lit(DELIMITER), F.lit(ESCAPE + "d"))


def unescaped(text: Column) -> Column:
    """The inverse; no escape is followed by anything but `e` or `d`, and those from escapes are undone last."""
    return F.replace(F.replace(text, F.lit(ESCAPE + "d"), F.lit(DELIMITER)), F.lit(ESCAPE + "e"), F.lit(ESCAPE))


def marked(text: Column, unit: str = CODE_POINT) -> Column:
    """Escaped text with a delimiter after each unit, the leftmost matches of a pattern. An escape with its letter is one code point, and a unit by itself."""
    inside, pattern = (unit[4:], "(?s)") if unit.startswith("(?s)") else (unit, "")
    return F.regexp_replace(escaped(text), f"{pattern}(?:{ESCAPE}[de]|{inside})", "$0" + DELIMITER)


def draws(rows: DataFrame, key: str, seed: int, count: int = 4) -> DataFrame:
    """rows with _h1, _h2, ...: numbers below 2^32 from the SHA-256 of the seed and the id, the same wherever and however often a row is read."""
    rows = rows.withColumn("_h", F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256))
    return rows.withColumns({f"_h{i + 1}": F.conv(F.substring("_h", 8 * i + 1, 8), 16, 10).cast("long") for i in range(count)}).drop("_h")


def parts(text: Column, delimiter: Column, count: Column) -> Column:
    """What lies before the count-th delimiter, or, for a negative count, after that one from the end."""
    return F.call_function("substring_index", text, delimiter, count.cast("int"))


def _bare(part: Column) -> Column:
    return unescaped(F.replace(part, F.lit(DELIMITER), F.lit("")))


def rebuilt(output: Column, form: Column, markers: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE)) -> Column:
    """The text that an output came from: its parts lie between the markers, which no transformed text holds."""
    p, s, m = (F.lit(x) for x in markers)

    def between(text: Column, first: Column, last: Column) -> Column:
        return parts(parts(text, last, F.lit(1)), first, F.lit(-1))

    middle = parts(output, m, F.lit(-1))
    psm = F.concat(between(output, p, s), middle, between(output, s, m))
    spm = F.concat(between(output, p, m), middle, between(output, s, p))
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)


def fill_in_middle(
    docs: DataFrame, seed: int = 1, plain: int = 10, spm: int = 20, unit: str = CODE_POINT, markers: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE), text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """docs with n (units), form, prefix, middle, suffix (null where plain) and output.

    Of 100 texts, `plain` stay as they are, as do those that are empty or hold a marker; of the others' 100, `spm` put the suffix first. Texts that a unit pattern
    doesn't cover to the end keep what follows the last unit in the suffix.
    """
    p, s, m = markers
    rows = docs.drop(*RESULT).withColumn("_t", F.coalesce(F.col(text), F.lit(""))).withColumn("_u", marked(F.col("_t"), unit))
    rows = rows.withColumn("n", (F.length("_u") - F.length(F.replace("_u", F.lit(DELIMITER), F.lit("")))).cast("long"))
    rows = draws(rows, key, seed)
    first, second = F.col("_h1") % (F.col("n") + 1), F.col("_h2") % (F.col("n") + 1)
    stays = (F.col("_t") == "") | F.contains("_t", F.lit(p)) | F.contains("_t", F.lit(s)) | F.contains("_t", F.lit(m)) | (F.col("_h3") % 100 >= 100 - plain)
    rows = rows.withColumns({"_a": F.least(first, second), "_b": F.greatest(first, second), "form": F.when(stays, "plain").when(F.col("_h4") % 100 < spm, "spm").otherwise("psm")})
    cut = F.col("form") != "plain"
    # the parts before the a-th and the b-th delimiter; what lies between them; what lies after the b-th
    head = parts(F.col("_u"), F.lit(DELIMITER), F.col("_b"))
    middle = parts(head, F.lit(DELIMITER), F.col("_a") - F.col("_b"))
    suffix = parts(F.col("_u"), F.lit(DELIMITER), F.col("_b") - F.col("n") - 1)
    prefix = parts(F.col("_u"), F.lit(DELIMITER), F.col("_a"))
    rows = rows.withColumns({"prefix": F.when(cut, _bare(prefix)), "middle": F.when(cut, _bare(middle)), "suffix": F.when(cut, _bare(suffix))})
    psm = F.concat(F.lit(p), "prefix", F.lit(s), "suffix", F.lit(m), "middle")
    other = F.concat(F.lit(s), "suffix", F.lit(p), "prefix", F.lit(m), "middle")
    return rows.withColumn("output", F.when(~cut, F.col("_t")).when(F.col("form") == "psm", psm).otherwise(other)).drop("_t", "_u", "_a", "_b", "_h1", "_h2", "_h3", "_h4")


def digests(docs: DataFrame, seed: int = 1, **settings) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, and the SHA-256 of the output and of the text rebuilt from it."""
    done = fill_in_middle(docs.select("doc_id", "text"), seed, **settings)
    return done.select(
        "doc_id", "n", "form", F.length("prefix").cast("long").alias("prefix_chars"), F.length("middle").cast("long").alias("middle_chars"),
        F.sha2("output", 256).alias("output_sha256"), F.sha2(rebuilt(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )
