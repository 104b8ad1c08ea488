"""URL verdicts: rules of hosts and paths, and for the rest logistic regression on hashed character n-grams.

All of it is Spark functions and Spark ML; no Python code sees a row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Lengths of the character n-grams, and how many values they are hashed to.
GRAMS = (3, 4, 5)
FEATURES = 1 << 16
#: Most labelled URLs that the model is fitted on, in order of their hashes.
MOST_LABELLED = 20_000
#: Above this probability a URL without a rule is blocked.
THRESHOLD = 0.5

#: The default labelled table, made by hand: hosts and paths as they occur, by verdict.
BLOCKED = """
casino-royal-slots.biz/play/now/112 bestcasino777.net/bonus/free-spins online-casino.example/win/jackpot
luckywin-slots.com/casino/9 poker-bet-live.info/tables/3 winbet365.xyz/sports/odds/881
mega-jackpot-win.club/spin bet-and-win.online/bonus?id=4 freespins-casino.top/en/223
slots4win.example/casino/bonus roulette-win.site/play poker-casino-bonus.org/en/play
spamfarm-links.info/p/1182 link-farm-seo.biz/page/99 cheap-backlinks-farm.com/buy
seo-spam-network.net/links/4 article-spam.info/spin/7712 content-farm.top/a/9921 spammy-links.xyz/en/99
spam-blog-network.com/post/8 linkspam.example/de/713 splog-farm.net/tag/cheap
hot-xxx-videos.com/watch/18 free-porn-tube.net/video/5512 adult-cams-live.xyz/room/3 sexchat-free.club/en/10
xxx-porn-pics.biz/gallery/2 nude-webcams.top/live porn-hd-xxx.info/v/8172 adultdating-sex.site/join
escort-girls-sex.net/city/1 milf-porn.example/en/918
cheap-viagra-pills.com/order buy-cialis-online.biz/cheap pharma-pills-discount.ru/viagra/100mg
no-prescription-meds.top/buy/pills weight-loss-pills.info/buy-now diet-pills-cheap.club/order/5
payday-loans-fast.com/apply quick-cash-loan.biz/approved/now easy-loans-bad-credit.net/apply/1
make-money-fast.xyz/earn/daily get-rich-crypto.club/invest/double bitcoin-doubler.top/deposit
forex-profit-signals.info/join work-from-home-cash.biz/earn free-money-survey.site/claim/8
ads.doubletraffic.net/banner/300x250 adserver.popunder.biz/click?id=88 track.clickbank-ads.com/pixel.gif
banner.adnetwork.xyz/show/77 popads.click/landing/2 tracker.ad-stats.net/collect redirect.clicktrack.top/go/12
free-gift-cards.win/claim-prize iphone-winner.club/claim you-won-prize.top/lucky/winner prize-claim-now.xyz/win
warez-crack-keygen.net/download/serial cracked-software-free.info/keygen torrent-movies-free.biz/download/771
free-download-crack.top/setup.exe nulled-scripts.club/warez keygen-serials.example/crack/5
replica-watches-cheap.com/rolex cheap-handbags-outlet.biz/louis fake-passports.top/buy discount-outlet-cheap.xyz/sale
paypal-login-verify.top/account/confirm secure-bank-login.xyz/verify/update appleid-verify.club/login
casino-games-online.net/en/71 free-bets-today.com/fr/310.html m.betting-tips-free.org/de/22/ www.cheap-meds.net/en/481
pills-online-cheap.com/es/17 ads-click.net/en/912 m.ad-tracking.com/en/55.html track-ads-server.org/fr/8
adult-videos.net/en/31/ www.xxx-adult.com/de/6 blog.spam-mails.net/en/700 spam-site.com/es/45 link-spam-farm.org/en/3
win-prizes.net/en/204 www.free-casino.com/en/18.html m.poker-win.net/fr/90/ loans-cheap.org/en/12
account-suspended-verify.info/login.php update-billing-login.site/secure hotmail-verify.biz/login/confirm
""".split()
ALLOWED = """
www.museum-harbour.org/collections/ships/112 news.rivervalley.com/2021/05/town-meeting blog.gardenpath.net/en/4411
library.stateuni.edu/catalogue/item/8812 en.openencyclopedia.org/wiki/River m.dailyherald.com/en/8123.html
docs.parserkit.org/guide/install www.cityhall.gov/services/permits journal.plantscience.org/articles/771
blog.mountaintrail.example/de/3412 www.thewritersroom.net/essays/17 history.oldtown.org/archive/1911
recipes.homekitchen.com/soup/lentil forum.woodworking.net/thread/2211 shop.localbooks.com/novels/301
www.weatherstation.org/forecast/north photos.birdwatch.net/species/heron en.travelnotes.com/spain/sevilla
learn.mathcourse.edu/algebra/lesson/4 www.hospitaltrust.org/patients/visiting theatre.riverside.org/season/2022
news.example.org/fr/5512 m.northpost.com/en/page/18 www.farmersweekly.com/crops/wheat orchard-farm.org/visit
blog.thinking.example/en/7812 www.whether.net/de/914.html anthology.org/poems/88 thesis.university.edu/handle/123
station-timetable.com/trains/5 www.nationmuseum.org/tickets tionville.fr/fr/mairie/agenda
m.theherald.net/es/7731 gather.commons.org/en/518 thread.sewingclub.com/patterns/22 winter-sports.org/skiing/lessons
windmill-society.nl/en/mills/7 www.windowsill-garden.com/herbs betterliving.org/health/sleep
alphabet-school.edu/classes/2 www.slotcar-racing-history.org/cars/12 adsorption-lab.edu/papers/41
sussex-history.org.uk/villages/3 essex-council.gov/parks middlesex.edu/library/opening
pharmacology.medschool.edu/lectures/8 loanwords.linguistics.org/arabic/4 money-museum.org/coins/roman
analysis.dataclub.org/notes/5 trackandfield.org/results/2019 bannerman-castle.org/history
software-foundation.org/releases/3.2/notes www.opensource-tools.net/download/docs cranes-bridges.org/photos/1
science.magazine.com/articles/black-holes arts.weekly.net/reviews/film/77 philosophy.reader.org/plato/republic
www.parliament.gov/bills/2020/44 court.records.gov/cases/1881 transport.city.gov/bus/14
chess.schoolclub.org/games/55 knitting.patterns.net/jumper/9 astronomy.nightsky.org/planets/mars
geology.rocks.edu/field-trip/3 poetry.journal.org/issue/12/essay music.conservatory.edu/concerts
health.institute.org/vaccines/faq kids.science.net/volcano/experiment wiki.gamedesign.org/board-games
blog.codeandtea.net/python/lists dev.notes.example/en/118 tutorials.webcraft.org/css/grid
handbook.firstaid.org/burns local.history.net/mill/1840 archive.newsroom.com/1998/07/12/story
m.eveningstar.com/en/6541?page=2 www.tribune.example/fr/2219/ en.gazette.org/8812#top de.rundschau.net/de/3912
thoughts.ofareader.com/en/871 www.theother.net/en/4512 www.theranger.org/trails/5 thinkers.net/es/118.html
onthehill.com/en/3381 handmade.crafts.net/baskets/3 student.paper.edu/opinion/44 sailing.harbourclub.org/races
economics.review.org/trade/2014 www.oceanography.edu/tides/atlas climate.observatory.org/ice/greenland
farm.animals.org/sheep/wool cooperative.growers.net/apples/22 village.fete.org.uk/programme
translation.studio.net/de/notes/8 grammar.language.org/verbs/irregular dictionary.words.com/define/heron
www.railway.museum.org/engines/9 bridge.engineering.edu/lectures/2 castle.heritage.org/tours
reading.room.org/novels/1847 en.library.example/books/991 theatre.notes.net/en/2218
""".split()

#: Rules of the registered query: verdict, then host and beginning of the path.
RULES = ("allow org/", "block example.org/es/", "block example.org/en/1", "allow com/fr/", "block com/de/")


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The default labelled table: ``url, blocked`` (1.0 or 0.0)."""
    rows = [(f"https://{u}", float(b)) for b, urls in ((1, BLOCKED), (0, ALLOWED)) for u in urls]
    return spark.createDataFrame(rows, "url string, blocked double")


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def grams(characters: Column, kind: str) -> Column:
    """All n-grams of an array of characters, marked by ``kind``. Time grows with the length alone."""
    marked = []
    for n in GRAMS:
        joined = F.transform(
            characters, lambda c, i: F.concat(F.lit(kind), c, *[F.get(characters, i + k) for k in range(1, n)])
        )
        marked.append(F.filter(joined, lambda g: g.isNotNull()))  # those that would reach over the end
    return F.concat(*marked)


def featured(frame: DataFrame) -> DataFrame:
    """Adds ``features`` to rows with ``host, path``. Digits count as one, letters without case."""
    plain = [F.regexp_replace(F.lower(c), "[0-9]", "0") for c in (F.concat(F.lit("."), "host", F.lit(".")), F.col("path"))]
    frame = frame.select("*", F.split(plain[0], "").alias("host_letters"), F.split(plain[1], "").alias("path_letters"))
    marked = F.concat(grams(F.col("host_letters"), "h"), grams(F.col("path_letters"), "p"))
    frame = frame.withColumn("grams", marked).drop("host_letters", "path_letters")
    return HashingTF(numFeatures=FEATURES, binary=True, inputCol="grams", outputCol="features").transform(frame).drop("grams")


def train(labelled: DataFrame, most: int = MOST_LABELLED) -> LogisticRegressionModel:
    """Fits the model on ``url, blocked``, at most ``most`` rows (in order of the URLs' hashes). Rows with a
    null in either are left out."""
    rows = labelled.select(F.col("url"), F.col("blocked").cast("double").alias("label")).dropna()
    rows = rows.orderBy(F.xxhash64("url"), "url", "label").limit(most)
    rows = featured(rows.select("label", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")))
    return LogisticRegression(regParam=0.002, maxIter=60, threshold=THRESHOLD, standardization=False).fit(rows.select("label", "features"))


def ranked(rules: Sequence[str]) -> list[tuple[str, str, str, str]]:
    """Verdict, rule, host and path of each rule, those that win first: longer ones, then those of longer hosts, then blocks."""
    parsed = []
    for text in rules:
        verdict, rule = text.split(" ", 1)
        host, slash, rest = rule.partition("/")
        if verdict not in ("allow", "block") or not host or not slash:
            raise ValueError(f"no rule: {text!r}")
        parsed.append((verdict, rule, host.lower(), slash + rest))
    return sorted(parsed, key=lambda p: (-len(p[1]), -len(p[2]), p[0] != "block", p[1]))


def url_verdicts(
    pages: DataFrame,
    rules: Sequence[str] = RULES,
    labelled: DataFrame | None = None,
    id_column: str = "page_id",
    url_column: str = "url",
    most_labelled: int = MOST_LABELLED,
) -> DataFrame:
    """For each row ``page_id, host, path, rule, verdict, blocked_probability``.

    A rule ``"block example.org/es/"`` fits its host and all below it, where the path begins with the rule's;
    the longest rule that fits decides (of equally long ones that of the longer host, then a block). Rules become
    one conditional expression, so they may be some hundreds. The model decides the rest: ``block`` above
    ``THRESHOLD``. It is fitted on ``labelled(url, blocked)``, by default on the small table of this module.

    A null URL and one without ``://`` have empty host and path: no rule fits, and without n-grams the model answers
    with its intercept. Repeated rows are judged each, a null id stays, an empty table gives no rows, other
    columns of any name are left out. ``rule`` is null where none fits.
    """
    model = train(labelled if labelled is not None else labelled_urls(pages.sparkSession), most_labelled)
    url = F.col(f"`{url_column}`")
    rows = pages.select(F.col(f"`{id_column}`").alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    rule = verdict = None
    for decision, text, host, path in ranked(rules):
        fits = ((F.col("host") == host) | F.endswith("host", F.lit(f".{host}"))) & F.startswith("path", F.lit(path))
        rule = F.when(fits, text) if rule is None else rule.when(fits, text)
        verdict = F.when(fits, decision) if verdict is None else verdict.when(fits, decision)
    none = F.lit(None).cast("string")
    rows = rows.withColumn("rule", none if rule is None else rule).withColumn("ruled", none if verdict is None else verdict)
    scored = model.setProbabilityCol("odds").setPredictionCol("guess").setRawPredictionCol("margin").transform(featured(rows))
    guessed = F.when(F.col("guess") == 1.0, "block").otherwise("allow")
    return scored.select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("ruled", guessed).alias("verdict"),
        F.get(vector_to_array("odds"), F.lit(1)).alias("blocked_probability"),
    )
