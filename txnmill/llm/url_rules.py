"""URL filter: a list of rules by host and path, and association rules mined from what is labelled.

An address is taken as a set of tokens: scheme, every label of the host, every path segment with its depth,
every query key, and whether it has a fragment. Spark's FP-growth finds the combinations of tokens that
are frequent together with a label among the distinct labelled addresses. Rules ``tokens => label`` are kept if
they reach a support and a confidence and no rule of fewer of their tokens is as confident for that label.

Rules are ranked by confidence, support, fewer tokens and text. An inverted index files each under its rarest
token, as all its tokens have to be there; the lists are in order of rank, so a lookup ends at the first rule
that matches and stops in every other list where ranks are worse. The best rule that matches an address decides,
and the ``default`` where none does.

The model is bounded by parameters: about ``fit_rows`` distinct addresses, drawn by their hash; of each of these the
``max_tokens`` most frequent tokens, as their combinations double with every token; and at most ``max_rules`` rules,
the best by rank, which are all that is sent to the executors. Every address is judged by all its tokens and
where it lies, without a shuffle.

Defined cases: an address that is null or has no ``://`` has empty host and path and no token; it gets the default.
Without labelled addresses there are no rules. Rows are judged one by one, so repeated rows and ids and null ids
stay, each with its verdict. Addresses that are labelled both ways count once for each. Other columns are ignored,
whatever their names.
"""

from collections.abc import Sequence
from functools import cache

import pandas as pd
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnmill.llm.common import staged, workers_see_package

FIT_ROWS, MAX_RULES = 200_000, 50_000
MIN_SUPPORT, LEAST_URLS = 0.005, 20
MIN_CONFIDENCE = 0.8
MAX_TOKENS = 12
MAX_SHARE = 0.9  # tokens of more than this share of the labelled addresses are left out of rules
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ListedRule = tuple[str, str, str]  # verdict, host, path


def _after_scheme(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def url_host(url: Column) -> Column:
    """What stands between the first ``://`` and the next ``/``, ``?`` or ``#``, with A-Z in lower case."""
    host = F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to the next ``?`` or ``#``."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"(?s)^[^/?#]*([^?#]*)", 1), F.lit(""))


def url_tokens(url: Column) -> Column:
    """Distinct tokens of an address, digits of path segments as ``#``; none without ``://``."""
    rest = _after_scheme(url)
    lower = F.lower(url)
    segments = F.filter(F.split(F.regexp_replace(F.lower(url_path(url)), "[0-9]+", "#"), "/"), lambda s: s != "")
    query = F.regexp_extract(rest, r"(?s)^[^?#]*\?([^#]*)", 1)
    keys = F.transform(F.split(F.lower(query), "&"), lambda pair: F.substring_index(pair, "=", 1))
    parts = [
        F.array(F.concat(F.lit("s:"), F.substring_index(lower, "://", 1))),
        F.transform(F.split(url_host(url), r"\."), lambda label: F.concat(F.lit("h:"), label)),
        F.transform(segments, lambda s, i: F.concat(F.lit("p"), (i + 1).cast("string"), F.lit(":"), s)),
        F.transform(F.filter(keys, lambda k: k != ""), lambda k: F.concat(F.lit("q:"), k)),
        F.when(F.contains(rest, F.lit("#")), F.array(F.lit("f:"))).otherwise(F.array().cast("array<string>")),
    ]
    return F.when(F.locate("://", url) > 0, F.array_distinct(F.concat(*parts))).otherwise(
        F.array().cast("array<string>")
    )


def _longest_first(listed: Sequence[ListedRule]) -> list[ListedRule]:
    return sorted(listed, key=lambda rule: (-len(rule[1] + rule[2]), rule))


def _fits(host: Column, path: Column, rule: ListedRule) -> Column:
    its_host = (host == rule[1]) | F.endswith(host, F.lit(f".{rule[1]}"))
    return its_host & F.startswith(path, F.lit(rule[2]))


def listed_rule(host: Column, path: Column, listed: Sequence[ListedRule]) -> tuple[Column, Column]:
    """Longest listed rule that fits, as ``host/path`` text, and its verdict; nulls if none does.

    A rule fits its host and all subdomains if the path starts with the rule's. The list is meant to be
    short: its rules become one expression.
    """
    name = verdict = F.lit(None).cast("string")
    for rule in reversed(_longest_first(listed)):
        fits = _fits(host, path, rule)
        name = F.when(fits, F.lit(rule[1] + rule[2])).otherwise(name)
        verdict = F.when(fits, F.lit(rule[0])).otherwise(verdict)
    return name, verdict


def mine_rules(
    labelled: DataFrame,
    url_col: str = "url",
    label_col: str = "label",
    min_support: float = MIN_SUPPORT,
    min_confidence: float = MIN_CONFIDENCE,
    least_urls: int = LEAST_URLS,
    max_share: float = MAX_SHARE,
    fit_rows: int = FIT_ROWS,
    max_tokens: int = MAX_TOKENS,
    max_rules: int = MAX_RULES,
    left_out: Sequence[str] = (),
) -> "RuleIndex":
    """Index of the rules that the labelled addresses bear out; see the module for what is kept.

    ``left_out`` names tokens that decided which addresses are labelled and so are no evidence.
    """
    known = labelled.select(F.col(url_col).alias("url"), F.col(label_col).cast("string").alias("label"))
    known = staged(known.filter("url is not null and label is not null").distinct(), "labelled")
    total = known.count()
    if total == 0:
        return RuleIndex([], {})
    if total > fit_rows:
        # high and low half of the hash together are uniform in 0 to 1
        known = known.filter(F.pmod(F.xxhash64("url"), F.lit(1 << 30)) < int(fit_rows / total * (1 << 30)))
    baskets = staged(known.select(url_tokens(F.col("url")).alias("tokens"), "label"), "baskets")
    n = baskets.count()
    if n == 0:
        return RuleIndex([], {})
    least = max(min_support, min(1.0, least_urls / n))
    counts = baskets.select(F.explode("tokens").alias("token")).groupBy("token").count()
    # tokens below the support cannot be in a rule, so there are at most tokens-per-address / support of them
    often = {r["token"]: r["count"] for r in counts.filter(F.col("count") >= least * n).collect()}
    usable = [t for t, count in often.items() if count <= max_share * n and t not in left_out]
    usable.sort(key=lambda t: (-often[t], t))
    frequent = F.array_intersect(F.array(*map(F.lit, usable)).cast("array<string>"), F.col("tokens"))
    items = F.concat(
        F.slice(frequent, 1, max_tokens),
        F.array(F.concat(F.lit("="), F.col("label"))),
    )
    growth = FPGrowth(itemsCol="items", minSupport=least, minConfidence=min_confidence)
    model = growth.fit(baskets.select(items.alias("items")))
    label = F.col("consequent")[0]
    rules = model.associationRules.filter(
        label.startswith("=") & ~F.exists("antecedent", lambda token: token.startswith("="))
    ).select(
        F.array_sort("antecedent").alias("tokens"),
        F.substr(label, F.lit(2)).alias("label"),
        "confidence",
        "support",
    )
    best = rules.orderBy(F.desc("confidence"), F.desc("support"), F.size("tokens"), "tokens", "label")
    return RuleIndex([tuple(r) for r in best.limit(max_rules).collect()], often)


class RuleIndex:
    """Rules in order of rank, filed under their rarest token."""

    def __init__(self, rules: list[tuple[list[str], str, float, float]], counts: dict[str, int]):
        self.rules = self._without_idle(rules)
        self.lists: dict[str, list[int]] = {}
        for rank, (tokens, *_) in enumerate(self.rules):
            rarest = min(tokens, key=lambda token: (counts.get(token, 0), token))
            self.lists.setdefault(rarest, []).append(rank)

    @staticmethod
    def _without_idle(rules):
        """Rules that are more confident than every rule of the same label and fewer of their tokens."""
        confidence = {(frozenset(tokens), label): c for tokens, label, c, _ in rules}

        @cache
        def below(tokens: frozenset, label: str) -> float:
            """Greatest confidence of any rule of fewer of the tokens."""
            fewer = [tokens - {token} for token in tokens] if len(tokens) > 1 else []
            return max((max(confidence.get((s, label), 0.0), below(s, label)) for s in fewer), default=0.0)

        kept = [
            (frozenset(tokens), label, c, support)
            for tokens, label, c, support in rules
            if c > below(frozenset(tokens), label)
        ]
        return sorted(kept, key=lambda r: (-r[2], -r[3], len(r[0]), sorted(r[0]), r[1]))

    def best(self, tokens) -> int | None:
        """Rank of the best rule whose tokens are all there."""
        there = set(tokens)
        best = len(self.rules)
        for token in there:
            for rank in self.lists.get(token, ()):
                if rank >= best:
                    break
                if self.rules[rank][0] <= there:
                    best = rank
        return best if best < len(self.rules) else None

    def __call__(self, tokens: Column) -> Column:
        """Struct of label, confidence and the tokens of the best rule; nulls without one."""

        @F.pandas_udf("struct<label: string, confidence: double, because: string>")
        def matched(column: pd.Series) -> pd.DataFrame:
            rows = []
            for there in column:
                rank = None if there is None else self.best(there)
                if rank is None:
                    rows.append((None, None, None))
                else:
                    its_tokens, label, confidence, _ = self.rules[rank]
                    rows.append((label, confidence, " ".join(sorted(its_tokens))))
            return pd.DataFrame(rows, columns=["label", "confidence", "because"]).astype(
                {"label": "object", "confidence": "float64", "because": "object"}
            )

        return matched(tokens)


def judged(
    pages: DataFrame,
    listed: Sequence[ListedRule] = (),
    rules: RuleIndex | None = None,
    id_col: str = "page_id",
    url_col: str = "url",
    default: str = "allow",
) -> DataFrame:
    """(id, host, path, rule, verdict, confidence, because) of every address: the verdict of the longest
    listed rule, else of the best mined one, whose confidence and tokens are told, else the default."""
    workers_see_package(pages.sparkSession)
    url = F.col("url")
    parts = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url")).select(
        "id", "url", url_host(url).alias("host"), url_path(url).alias("path")
    )
    rule, verdict = listed_rule(F.col("host"), F.col("path"), listed)
    known = parts.select("*", rule.alias("rule"), verdict.alias("listed"))
    found = (rules or RuleIndex([], {}))(F.when(F.col("rule").isNull(), url_tokens(url)))
    return known.withColumn("found", found).select(
        F.col("id").alias(id_col),
        "host",
        "path",
        "rule",
        F.coalesce("listed", "found.label", F.lit(default)).alias("verdict"),
        "found.confidence",
        "found.because",
    )


def host_tokens(listed: Sequence[ListedRule]) -> list[str]:
    """Tokens of the hosts of listed rules."""
    return sorted({f"h:{label}" for _, host, _ in listed for label in host.split(".")})


def labelled_by_list(pages: DataFrame, listed: Sequence[ListedRule], url_col: str = "url") -> DataFrame:
    """(url, label) of the addresses that a listed rule decides."""
    url = F.col(url_col)
    _, verdict = listed_rule(url_host(url), url_path(url), listed)
    return pages.select(url.alias("url"), verdict.alias("label")).filter("label is not null")
