"""Synthetic attributes for keyed rows, and integrity checks of their references."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Vocabularies of the synthetic star schema.
CORPORATIONS = ["T-Mobile", "Sound Transit", "Koss", "Subaru", "PUD"]
ORG_TYPES = ["communication", "transportation", "audio devices", "cars", "utilities"]
METHODS = ["malware", "insider threat", "hacking", "physical breach", "accidental publishment"]
RECORDS = [9025, 1689, 514575, 866126, 259333]
SENSITIVITIES = [0.5, 0.7, 0.0, 0.2, 0.9]
TITLES = [
    "Data stolen from company", "Cookie recipe", "User info leaked",
    "Cybersecurity attack succeeds", "Best hiking trails",
]
CATEGORIES = ["data", "cooking", "consumer security", "cybersecurity", "recreation"]
LANGUAGES = ["eng", "spanish", "italian", "tagalog", "portugese"]
COUNTRIES = ["US", "Mexico", "Italy", "Philippines", "Brazil"]
PUBLISHERS = ["MSNBC", "FOX", "CNN", "NY Times", "Washington Post"]


def _draw(key: Column, name: str, n: int, seed: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(name), F.lit(seed)), F.lit(n)).cast("int")


def _pick(values: list, index: Column) -> Column:
    return F.array(*(F.lit(v) for v in values))[index]


def synthetic_events(keys: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """One breach per key, attributes drawn by hash of the key."""
    k = F.col(key)
    return keys.select(
        k.alias("breach_id"),
        *(
            _pick(values, _draw(k, name, len(values), seed)).alias(name)
            for name, values in {
                "corp_name": CORPORATIONS,
                "num_records": RECORDS,
                "method": METHODS,
                "sensitivity": SENSITIVITIES,
            }.items()
        ),
    )


def synthetic_articles(keys: DataFrame, key: str, breach: str, seed: int = 42) -> DataFrame:
    """One article per key; title and category share an index."""
    k = F.col(key)
    subject = _draw(k, "subject", len(TITLES), seed)
    return keys.select(
        k.alias("article_id"),
        _pick(TITLES, subject).alias("title"),
        _pick(CATEGORIES, subject).alias("category"),
        *(
            _pick(values, _draw(k, name, len(values), seed)).alias(name)
            for name, values in {
                "lang": LANGUAGES,
                "country": COUNTRIES,
                "publisher": PUBLISHERS,
            }.items()
        ),
        F.col(breach).alias("breach_id"),
    )


def synthetic_corporations(df: DataFrame, corp: str) -> DataFrame:
    """Organisation type of the corporations that occur."""
    pairs = F.create_map(*(F.lit(x) for kv in zip(CORPORATIONS, ORG_TYPES) for x in kv))
    return df.select(F.col(corp).alias("corp_name")).distinct().withColumn(
        "org_type", F.try_element_at(pairs, F.col("corp_name"))
    )


def orphan_keys(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Rows whose non-null foreign key has no parent."""
    return child.filter(F.col(child_key).isNotNull()).join(
        parent.select(parent_key), F.col(child_key) == F.col(parent_key), "left_anti"
    )
