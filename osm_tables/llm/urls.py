"""URL filters: rules by host and path, and a classifier where no rule fits.

The classifier is a logistic regression on hashed character n-grams of host and path, fitted on a
small table of labelled URLs. Everything runs in DataFrame functions and Spark ML.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SIZES = (3, 4, 5)
FEATURES = 1 << 13

#: Host, path and verdict of each rule.
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]

#: Words of site names to learn from, general ones of each kind.
BLOCKED_WORDS = """
casino poker roulette jackpot blackjack betting bookie gamble lottery wager slots bingo
pharmacy pills viagra steroids dosage painkiller rx meds
porn adult escort erotic nude webcam xxx sexy
adserver banner popup tracker tracking clickbait affiliate advert ads
spam phishing malware loans payday hacked giveaway replica counterfeit warez
""".split()
ALLOWED_WORDS = """
news library university encyclopedia garden recipe museum weather council science map health school travel history daily
music code thermal cinema hiking bakery opera river forest mountain village parish county bridge station railway harbour
letter poem novel grammar physics chemistry biology geology algebra statistics theatre orchestra painting sculpture
football cycling swimming chess sailing farm orchard cheese bread kitchen furniture carpenter plumber electric repair
court parliament ministry police hospital clinic dentist charity church temple archive journal review magazine radio
hotel hostel airport ferry tram bicycle garage insurance bank market bookshop florist tailor wedding children toys
schule zeitung wetter rathaus verein reise kirche garten ecole mairie journal voyage jardin bibliotheque musee meteo
escuela noticias tiempo ayuntamiento viaje iglesia jardin biblioteca museo ciencia salud
""".split()
#: What stands beside a word in a name, alike for both kinds.
_BESIDE = ["", "best-", "my", "the", "-online", "-24", "world", "-home", "free-", "-club", "top", "-direct"]


def names_of(words: list[str]) -> list[str]:
    """Each word as three names, alone and with what often stands beside one."""
    out = []
    for i, word in enumerate(words):
        for k in range(3):
            other = _BESIDE[(i + 5 * k) % len(_BESIDE)]
            out.append(word + other if other.startswith("-") else other + word)
    return out


_BEFORE = ["", "www.", "m.", "blog."]
_AFTER = [".example.com", ".example.net", ".example.org", ".com", ".net", ".org"]
_PATHS = ["/en/1", "/de/2.html", "/fr/3/", "/es/4", "/", "/page"]


def labelled_urls(blocked=tuple(BLOCKED_WORDS), allowed=tuple(ALLOWED_WORDS)) -> list[tuple[str, float]]:
    """Names of each word as a few hosts and paths; what is around a name is alike for both labels."""
    out = []
    for words, label in ((blocked, 1.0), (allowed, 0.0)):
        for i, name in enumerate(names_of(list(words))):
            for k in range(4):
                out.append((f"{_BEFORE[(i + k) % 4]}{name}{_AFTER[(i + 2 * k + k // 3) % 6]}{_PATHS[(i // 2 + k) % 6]}", label))
    return out


def split_url(url: Column) -> tuple[Column, Column]:
    """Host in lower case (A-Z) and path; both empty without ``://``."""
    url = F.coalesce(url, F.lit(""))
    parts = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(F.regexp_extract(url, parts, 1), upper, lower), F.regexp_extract(url, parts, 2)


def rule_for(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, else nulls; of equally long ones the longest host, then the first by name."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for own_host, own_path, own in sorted(rules, key=lambda r: (len(r[0]) + len(r[1]), len(r[0]), [-ord(c) for c in r[0] + r[1]])):
        fits = ((host == own_host) | host.endswith("." + own_host)) & path.startswith(own_path)
        name, verdict = F.when(fits, own_host + own_path).otherwise(name), F.when(fits, own).otherwise(verdict)
    return name, verdict


def grams(host: Column, path: Column) -> Column:
    """Character n-grams of host and path, marked by which they are of; ends count as characters."""

    def of(text: Column, mark: str) -> Column:
        text = F.concat(F.lit("^"), text, F.lit("$"))

        def of_size(n: int) -> Column:
            last = F.length(text) - n
            places = F.when(last >= 0, F.sequence(F.lit(0), F.greatest(last, F.lit(0)))).otherwise(F.array().cast("array<int>"))
            return F.transform(places, lambda i: F.concat(F.lit(mark), text.substr(i + 1, F.lit(n))))

        parts = [of_size(n) for n in SIZES]
        return F.concat(*parts)

    # Numbers in paths say nothing; they are all written as 0.
    return F.concat(of(host, "h"), of(F.regexp_replace(path, "[0-9]+", "0"), "p"))


def train(spark: SparkSession, rows: list[tuple[str, float]] | None = None, *, features: int = FEATURES, penalty: float = 0.0005) -> PipelineModel:
    """A classifier fitted on labelled ``host/path`` strings (1: block)."""
    pairs = [F.struct(F.lit(u).alias("url"), F.lit(y).alias("label")) for u, y in rows or labelled_urls()]
    urls = F.explode(F.array(*pairs)).alias("x")
    labelled = spark.range(0, 1, 1, 1).select(urls).select("x.*")
    host, path = split_url(F.concat(F.lit("http://"), "url"))
    labelled = labelled.select("label", grams(host, path).alias("grams"))
    stages = [
        HashingTF(numFeatures=features, inputCol="grams", outputCol="features"),
        LogisticRegression(featuresCol="features", regParam=penalty, maxIter=200, standardization=False, probabilityCol="chances"),
    ]
    return Pipeline(stages=stages).fit(labelled)


def judge_urls(pages: DataFrame, model: PipelineModel, rules=RULES, threshold: float = 0.5) -> DataFrame:
    """For every row of ``pages`` (page_id, url): host, path, the rule that decides (or null), verdict and score.

    The verdict is the rule's; without one ``block`` if the classifier's probability (``score``)
    reaches ``threshold``. Null urls and those without ``://`` have an empty host and path, and no
    URL to judge: score 0, allowed. Repeated rows are judged alike; other columns are not read.
    """
    host, path = split_url(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    rows = rows.withColumn("grams", grams(F.col("host"), F.col("path")))
    chance = vector_to_array(F.col("chances"))[1]
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    score = F.when((F.col("host") == "") & (F.col("path") == ""), F.lit(0.0)).otherwise(chance)
    scored = model.transform(rows).select("page_id", "host", "path", rule.alias("rule"), verdict.alias("ruled"), score.alias("score"))
    own = F.when(F.col("score") >= threshold, "block").otherwise("allow")
    return scored.select("page_id", "host", "path", "rule", F.coalesce("ruled", own).alias("verdict"), "score")
