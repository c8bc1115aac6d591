"""URL filter: host and path rules, then logistic regression.

Where no rule decides, a logistic regression on hashed character n-grams of
host and path does.  It is fitted by Spark on a small table of labelled URLs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

NGRAMS = (3, 4, 5)
FEATURES = 1 << 16
REGULARIZATION = 0.005
#: Probability from which a url is blocked: high, as a wrong block loses a page.
THRESHOLD = 0.8
#: Rules are few: they are part of the expression.
MAX_RULES = 10_000

# Invented host names, by kind of unwanted and of ordinary site.
BLOCKED = """
grand-casino casinoroyale vegas-casino casino777 live-casino slots-online mega-slots jackpot-slots luckyspins
roulette-live poker-night pokerstake blackjack-pro bet-online sportsbet betting-tips bets365 bet-bonus wager-club
winbig-lotto lottery-winner win-prizes bigwins free-spins freechips free-money freegifts free-prizes
pills-store pillsdirect diet-pills online-pharmacy pharma-discount cheap-meds cheapviagra viagra-shop steroid-store
replica-watches cheap-handbags fake-designer cheap-rolex cheap-followers miracle-cure
adult-dating adultchat adult-movies xxx-tube xxxvideos sex-chat sexcams hot-singles escort-girls nude-pics porn-tube
webcam-girls milf-dates strip-cams
spam-mailer bulkspam spamblast seo-spam link-exchange linkfarms content-mill article-spinner doorway-farm backlinks-farm
ads-banner adserver ad-clicks popup-ads popunder ads-network track-pixel tracker-hub clicktrack tracking-beacon affiliate-track
malware-host virus-exe crack-keygen warez-zone cracked-apps torrent-warez serial-keys phish-login account-verify
secure-login-update payday-cash fast-cash-loans instant-loans credit-repair-now crypto-doubler bitcoin-giveaway
get-rich-quick work-from-home-cash money-maker forex-signals
"""
ALLOWED = """
city-museum public-library state-university high-school garden-club weather-report daily-news evening-post science-journal
history-archive music-academy theatre-house film-review book-reviews recipes-kitchen travel-guide mountain-trails river-walks
harbour-town village-hall town-council national-park art-gallery science-centre health-clinic dental-care children-hospital
football-club tennis-court running-notes chess-problems knitting-patterns woodworking photo-album bird-watch sea-life
linux-notes python-tutorial open-data code-review math-forum physics-lab chemistry-class language-school dictionary
grammar-help poetry-corner short-stories radio-hour podcast-weekly film-society design-studio architecture garden-design
furniture-maker bakery-lane coffee-roaster tea-house restaurant-menu wine-cellar farm-shop flower-market bike-repair car-review
train-times bus-routes airport-info hotel-booking camping-sites hiking-maps ski-resort surf-school sailing-club
law-review tax-advice job-board company-register bank-branch insurance-guide housing-office charity-fund church-choir
parliament ministry election-results court-rulings patents census statistics encyclopedia wiki-commons translation
astronomy geology biology ecology climate ocean-study forest-service water-board energy-report solar-panels
the-other-side another-day throughout thereafter nation-building education information communication collection attention
reason-and-rhyme thinker weather-vane north-shore southern-post western-line eastern-light
"""
PREFIXES = ("", "www.", "shop.", "my.")
ZONES = (".com", ".org", ".info", ".co", ".eu")
PATHS = ("/", "/index.html", "/about/", "/2021/05/story.html", "/item?id=7", "/a/b/c", "", "/page/2#top")


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The built-in training table: (url, blocked).  Every name comes with
    every prefix, and zones and paths in turn, so that only names tell."""
    rows = [(f"https://{prefix}{name}{ZONES[(i + j) % len(ZONES)]}{PATHS[(5 * i + j) % len(PATHS)]}", label)
            for names, label in ((BLOCKED, 1.0), (ALLOWED, 0.0))
            for i, name in enumerate(names.split()) for j, prefix in enumerate(PREFIXES)]
    return spark.createDataFrame(rows, "url string, blocked double").coalesce(1)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased.  Path: then up to ``?``, ``#`` or the end.  Both are empty
    for a null url or one without ``://``."""
    at = F.locate("://", F.coalesce(url, F.lit("")))
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def _grams(text: Column, tag: str) -> Column:
    """Character n-grams of a text between marks, with the part's tag."""
    marked = F.concat(F.lit("\x02"), text, F.lit("\x03"))
    # each match takes one character and looks at the n from it on: linear in
    # the text, however long a url is
    return F.concat(*(F.transform(F.regexp_extract_all(marked, F.lit(f"(?s)(?=(.{{{n}}}))."), F.lit(1)),
                                  lambda gram: F.concat(F.lit(tag), gram)) for n in NGRAMS))


def _features(df: DataFrame, host: str, path: str, out: str) -> DataFrame:
    grams = F.concat(_grams(F.col(host), "h"), _grams(F.col(path), "p"))
    tf = HashingTF(numFeatures=FEATURES, binary=True, inputCol="_grams", outputCol=out)
    return tf.transform(df.withColumn("_grams", grams)).drop("_grams")


def fit(labelled: DataFrame) -> LogisticRegressionModel:
    """Fit on (url, blocked 0/1); rows without a label are left out.  The
    table must be small, and hold both labels."""
    host, path = host_and_path(F.col("url"))
    rows = labelled.where("blocked is not null").select(host.alias("_h"), path.alias("_p"),
                                                        F.col("blocked").cast("double").alias("label"))
    return LogisticRegression(regParam=REGULARIZATION, maxIter=100).fit(_features(rows, "_h", "_p", "features"))


def _rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; of equally long ones the
    blocking, then the first by code point."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    order = sorted(rules, key=lambda r: (-len(r[0]), r[1] != "block", r[0]))
    cases = []
    for rule, verdict in order:
        name, _, rest = rule.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(f"/{rest}")
        cases.append((fits, rule, verdict))
    def pick(i):
        return reduce(lambda out, c: out.when(c[0], F.lit(c[i])), cases[1:], F.when(cases[0][0], F.lit(cases[0][i])))
    return (pick(1), pick(2)) if cases else (F.lit(None).cast("string"), F.lit(None).cast("string"))


def judge(pages: DataFrame, rules: list[tuple[str, str]], model: LogisticRegressionModel,
          threshold: float = THRESHOLD) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule``, ``p_block`` and
    ``verdict`` of their ``url``.  They replace columns of those names; others
    are passed on.

    A rule is (``host/path``, ``allow`` or ``block``).  It fits its host and
    all subdomains if the path starts with the rule's; the longest wins, and
    where none fits, ``rule`` is null and the model blocks from a probability
    of ``threshold`` on.  Null urls and those without ``://`` have empty host
    and path, and are judged by the model.  Repeated rows have equal results;
    an empty table gives an empty table.
    """
    pages = pages.drop("host", "path", "rule", "p_block", "verdict")
    names = pages.columns
    host, path = host_and_path(F.col("url"))
    df = pages.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)),
                      host.alias("_host"), path.alias("_path"))
    rule, verdict = _rule(F.col("_host"), F.col("_path"), rules)
    df = model.transform(_features(df, "_host", "_path", model.getFeaturesCol()))
    p = vector_to_array(F.col(model.getProbabilityCol()))[1]
    return df.select(*(f"c{i}" for i in range(len(names))), "_host", "_path", rule.alias("_rule"), p.alias("_p"),
                     F.coalesce(verdict, F.when(p >= threshold, "block").otherwise("allow")).alias("_verdict")
                     ).toDF(*names, "host", "path", "rule", "p_block", "verdict")
