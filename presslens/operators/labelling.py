"""Prompts, replies, label validation and scoring of text rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from presslens.functions.text import BREACH_KEYWORDS, contains_keyword
from presslens.operators.vectors import knn

# Wording of the prompt and markers of the training fragments.
FORMAT_REQUEST = "\n\nYour answer should follow the format given in the examples:\n"
CLASSIFY_REQUEST = "Now classify the following: \n"
FRAGMENT_START, FRAGMENT_ANSWER, FRAGMENT_END = "<s>", "###>", "</s>"
NUM_EXAMPLES = 6

# Answer keys and the values allowed for them.
LABEL_PATTERNS = {"BreachMentioned": "true|True|false|False", "CompanyMentioned": r"\w{3,}"}


def lines_of(columns: dict[str, str], separator: str = " : ") -> Column:
    """'key : value' lines; null prints as the word None."""
    lines = [
        F.concat(F.lit(f"{label}{separator}"), F.coalesce(F.col(c).cast("string"), F.lit("None")))
        for label, c in columns.items()
    ]
    return F.concat_ws("\n", *lines)


def build_prompt(
    df: DataFrame,
    prefix: str,
    examples: str,
    keys: dict[str, str],
    out: str = "prompt",
    request: str = CLASSIFY_REQUEST,
) -> DataFrame:
    """Prefix, example blocks (an array of texts) and the keys to classify."""
    prompt = F.concat_ws(
        "\n\n",
        F.lit(prefix + FORMAT_REQUEST),
        F.array_join(F.col(examples), "\n\n"),
        F.concat(F.lit(request), lines_of(keys)),
    )
    return df.withColumn(out, prompt)


def build_fragment(
    df: DataFrame,
    prefix: str,
    keys: dict[str, str],
    answers: dict[str, str] | None = None,
    out: str = "fragment",
) -> DataFrame:
    """'<s>prefix keys ###> ' and, for training, 'answers</s>'."""
    parts = [F.lit(FRAGMENT_START + prefix), lines_of(keys, ": "), F.lit(f" {FRAGMENT_ANSWER} ")]
    if answers:
        parts += [lines_of(answers), F.lit(FRAGMENT_END)]
    return df.withColumn(out, F.concat(*parts))


def select_examples(
    rows: DataFrame,
    examples: DataFrame,
    id_col: str,
    example_id: str,
    vector: str,
    example_text: str,
    k: int = NUM_EXAMPLES,
    out: str = "examples",
) -> DataFrame:
    """The texts of the k nearest labelled examples of each row, nearest first.

    The labelled set is the small side; each row is finished inside its own batch.
    """
    near = knn(rows, examples, id_col, example_id, vector, k)
    texts = near.join(
        examples.select(F.col(example_id).alias("neighbour_id"), F.col(example_text).alias("_text")),
        "neighbour_id",
    )
    ordered = F.array_sort(F.collect_list(F.struct("rank", "_text")))
    grouped = texts.groupBy(id_col).agg(F.transform(ordered, lambda s: s["_text"]).alias(out))
    return rows.join(grouped, id_col)


def parse_response(
    df: DataFrame,
    response: str,
    keys: list[str],
    cut_before: str | None = None,
    repair_prefix: str | None = None,
) -> DataFrame:
    """One column per key from 'key: value' lines; the first line of a key wins.

    cut_before keeps only what follows a marker. repair_prefix puts 'prefix : ' in front
    when the first line has no colon, and drops what precedes it otherwise.
    """
    text = F.coalesce(F.col(response), F.lit(""))
    if cut_before is not None:
        at = F.instr(text, cut_before)
        text = F.when(at > 0, F.substring(text, at + F.lit(len(cut_before)), F.length(text))).otherwise(text)
    if repair_prefix is not None:
        text = F.trim(text)
        lead = f"{repair_prefix} : "
        first_line = F.split(text, "\n", 2)[0]
        text = F.when(first_line.contains(":"), text).otherwise(F.concat(F.lit(lead), text))
        at = F.instr(text, lead)
        text = F.when(at > 0, F.substring(text, at, F.length(text))).otherwise(text)
    pairs = F.transform(
        F.filter(F.split(text, "\n"), lambda line: line.contains(":")),
        lambda line: F.struct(
            F.trim(F.substring_index(line, ":", 1)).alias("key"),
            F.trim(F.substring(line, F.instr(line, ":") + 1, F.length(line))).alias("value"),
        ),
    )
    df = df.withColumn("_pairs", pairs)

    def first_value(key: str) -> Column:
        mine = F.filter("_pairs", lambda pair: pair["key"] == key)
        return F.try_element_at(mine, F.lit(1))["value"]

    return df.withColumns({key: first_value(key) for key in keys}).drop("_pairs")


def parse_blocks(df: DataFrame, response: str, keys: list[str], out: str = "block") -> DataFrame:
    """One row per blank-line separated block, keys compared without case."""
    blocks = df.select("*", F.posexplode(F.split(F.col(response), "\n\n")).alias(out, "_block"))
    lines = F.filter(F.split("_block", "\n"), lambda line: line.contains(":"))

    def value(key: str) -> Column:
        mine = F.filter(
            lines,
            lambda line: F.lower(F.trim(F.regexp_extract(line, r"^(.*?)\W*:", 1))) == key.lower(),
        )
        # A later line of the same key replaces an earlier one inside a block.
        return F.regexp_extract(F.try_element_at(mine, F.lit(-1)), r":\W*(.*)$", 1)

    return blocks.withColumns({key: value(key) for key in keys}).drop("_block")


def validate_labels(
    df: DataFrame,
    patterns: dict[str, str] | None = None,
    allowed: dict[str, set[str]] | None = None,
    out: str = "valid",
) -> DataFrame:
    """True where every label fully matches its pattern or is an allowed value in any case."""
    checks = [
        F.coalesce(F.col(c).rlike(f"^(?:{p})$"), F.lit(False)) for c, p in (patterns or {}).items()
    ]
    checks += [
        F.coalesce(F.lower(F.trim(F.col(c))).isin(*(v.strip().lower() for v in values)), F.lit(False))
        for c, values in (allowed or {}).items()
    ]
    valid = F.lit(True)
    for check in checks:
        valid = valid & check
    return df.withColumn(out, valid)


def score_in_batches(
    df: DataFrame,
    text: str,
    scorer: Callable[[pd.Series], pd.Series] | None = None,
    out: str = "label",
    out_type: str = "boolean",
    words: tuple[str, ...] = BREACH_KEYWORDS,
) -> DataFrame:
    """Append a score to every row. A scorer sees one Arrow batch of texts at a time
    (`spark.sql.execution.arrow.maxRecordsPerBatch` sets its size) and nothing else of the
    row; without one the keyword test runs natively."""
    if scorer is None:
        return df.withColumn(out, contains_keyword(F.col(text), words))

    @F.pandas_udf(out_type)
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield scorer(batch)

    return df.withColumn(out, score(F.col(text)))


def attach_predictions(
    df: DataFrame, predictions: DataFrame, keys: list[str], columns: list[str]
) -> DataFrame:
    """Add prediction columns by key; rows without a prediction stay null."""
    return df.join(predictions.select(*keys, *columns), keys, "left")
