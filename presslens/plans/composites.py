"""End-to-end analyses built from the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from presslens.functions.text import normalise_name
from presslens.operators.aggregates import compare_shares, conditional_sums, count_by
from presslens.operators.attribution import coverage_per_event
from presslens.operators.bins import rollup_small_to_other
from presslens.operators.cleaning import (
    between_dates,
    derive_by_name_pattern,
    drop_embedded_headers,
    drop_null,
    exclude_values,
    fill_null,
)
from presslens.operators.dedup import keep_earliest, keep_first, keep_largest
from presslens.operators.joins import left_join_fill, left_join_normalised
from presslens.operators.labelling import build_prompt, select_examples
from presslens.operators.stats import chi_square_gof, z_test_shares
from presslens.operators.vectors import sample_diagonal

# Communities left out, and mentions that are no company.
SUBS_TO_EXCLUDE = ["redditrequest", "modhelp", "needamod", "modclub", "modeveryone"]
NOT_A_COMPANY = ["False", "false", "Government", "government"]
NO_BREACH = ["flase", "False"]


def largest_per_name(companies: DataFrame, name: str, size: str, tiebreak: str) -> DataFrame:
    """One company per normalised name, so that joins by name do not fan out."""
    keyed = companies.withColumn("_name_key", normalise_name(F.col(name)))
    return keep_largest(keyed, ["_name_key"], size, [tiebreak]).drop("_name_key")


def event_coverage(
    articles: DataFrame, companies: DataFrame, events: DataFrame, max_days: int
) -> DataFrame:
    """Articles per event, zero included.

    articles(article_id, url, headline, publication, article_date, label, mention),
    companies(company_id, name, size, ...), events(breach_id, organisation, records,
    breach_date, ...).
    """
    about = exclude_values(drop_null(articles, ["label"]), "label", NO_BREACH)
    first = keep_earliest(
        about, [["url"], ["headline", "publication"]], "article_date", ["article_id"]
    )
    named = exclude_values(first, "mention", NOT_A_COMPANY, keep_null=False)
    # The largest company of each name is what the per-article choice would keep.
    known = largest_per_name(companies, "name", "size", "company_id")
    # Keys are columns, so that no sort computes them in its comparisons.
    ids = known.select(normalise_name(F.col("name")).alias("_name_key"), F.col("company_id").alias("article_company"))
    keyed = named.withColumn("_name_key", normalise_name(F.col("mention"))).filter("_name_key != ''")
    mentions = keyed.join(ids, "_name_key")
    matched = left_join_normalised(events, known, "organisation", "name")
    unique = keep_largest(
        matched, ["organisation", "records", "breach_date"], "size", ["breach_id"], fill=-1
    )
    return coverage_per_event(
        unique, mentions.select("article_company", "article_date"),
        [("company_id", "article_company")], "breach_date", "article_date", max_days,
    )


def representation_report(
    df: DataFrame,
    key: str,
    part: Column,
    threshold: float = 0.1,
    with_p: bool = True,
) -> DataFrame:
    """Shares of all rows and of a part, small categories rolled up, z test per category and
    chi-square over all, in one table."""
    shares = compare_shares(df, key, {"all": F.lit(True), "part": part})
    rolled = rollup_small_to_other(shares, key, "percentage_all", threshold)
    tested = z_test_shares(rolled, "percentage_part", "percentage_all", "count_part", with_p=with_p)
    fit = chi_square_gof(rolled, "count_part", "count_all", with_p=with_p)
    out = tested.withColumn("chi_square", fit.select("statistic").scalar())
    return out.withColumn("chi_square_p", fit.select("p_value").scalar()) if with_p else out


def moderator_features(
    tenures: DataFrame, activity: DataFrame, during: DataFrame, first, last
) -> DataFrame:
    """Tenures started in a date range with their activity counts and derived totals."""
    keys = ["mod", "subreddit", "started"]
    kept = between_dates(tenures, "started", first, last)
    return derive_by_name_pattern(left_join_fill(kept, [activity, during], keys))


def moderation_counts(
    items: DataFrame,
    removed: DataFrame,
    sentiments: tuple[str, ...] = ("positive", "neutral", "negative"),
    excluded: list[str] = SUBS_TO_EXCLUDE,
) -> DataFrame:
    """Sentiment counts per community and month beside the removed-content counts.

    items(id, subreddit, created (timestamp), sentiment); removed(subreddit, month 'yyyy-mm',
    counts ...).
    """
    unique = exclude_values(keep_first(items, ["id"], ["created", "subreddit"]), "subreddit", excluded)
    dated = unique.withColumns({"year": F.year("created"), "month": F.month("created")})
    counts = conditional_sums(
        dated, ["subreddit", "year", "month"],
        {f"{s}_mod_items": F.col("sentiment") == s for s in sentiments}, "all_mod_items",
    )
    parts = F.split("month", "-")
    other = exclude_values(removed, "subreddit", excluded).withColumns(
        {"year": parts[0].cast("int"), "month": parts[1].cast("int")}
    )
    return other.join(counts, ["subreddit", "year", "month"], "full_outer")


def event_and_org_filter(
    articles: DataFrame, url: str, order: list[str], breach: str, company: str, publication: str
) -> DataFrame:
    """Articles per publication among unique ones that name a breach and a company."""
    unique = keep_first(articles, [url], order)
    filled = fill_null(unique, {breach: "False", company: "False"})
    both = exclude_values(filled, breach, ["False", "false"])
    both = exclude_values(both, company, NOT_A_COMPANY)
    counts = count_by(drop_embedded_headers(both, [publication]), [publication])
    return counts.orderBy(F.desc("count"), publication)


def labelled_prompt_set(
    rows: DataFrame,
    examples: DataFrame,
    id_col: str,
    example_id: str,
    vector: str,
    example_text: str,
    keys: dict[str, str],
    prefix: str,
    n: int = 200,
    k: int = 6,
) -> DataFrame:
    """Rows spread over the vector space, each with a prompt of its nearest examples."""
    sampled = sample_diagonal(rows, id_col, vector, n)
    chosen = select_examples(sampled, examples, id_col, example_id, vector, example_text, k)
    return build_prompt(chosen, prefix, "examples", keys)
