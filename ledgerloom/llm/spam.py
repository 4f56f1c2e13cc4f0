"""Problem 9: keyword-stuffed pages and pages of links or product tags.

1. Features of content and links: a page is read in stretches of a dozen words; each word is a link, a
   label beside a link, a tag, a number, a small word of running text, or another word.
2. Weak labels: labelling functions, each of one kind of evidence (links, tags, one word over and over, words repeated without running text, few different words;
   running text, figures, shortness, other scripts), vote or abstain. A page is labelled where all that
   vote agree. They see only the plain cases; no function knows any word of the trade.
3. Bagged decision trees (a random forest) are trained on a bounded sample of the labelled pages, and
   score every page.
4. The pages' scores are averaged by host and shrunk towards the whole corpus by as much as the hosts' differences
   are no more than chance (their variance beyond that of the pages within them), and a page's log odds move by what
   its host's differ from the corpus's. Averages are partial aggregates, so a host may hold any share of the pages.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import cut_lineage

#: Labelled pages used for training at most; they are drawn by a hash of their id.
TRAIN_ROWS = 20_000
TREES, DEPTH, SEED = 40, 6, 7
STRETCH = 12

#: Small words that running text in the corpus's languages cannot do without.
SMALL_WORDS = frozenset(
    """a an and are as at be been but by for from had has have he her his if in into is it its let no nor not of on or our out over
    said says she so some such than that the their them then there they this though to under upon was we were what when where which
    while who whom whose will with would you your my me oh all
    der die das den dem des ein eine einen einem und oder daß dass nicht ist sind war wäre mit von zu im am auf um an für nach bei wird es er sie als
    le la les un une des du de et ou que qui il elle ne pas est était avait été sur dans par pour au aux en a son sa ses qu l d s n y
    el los las una y o que en del al por con para su sus se no es era fue más está han ha lo""".split()
)
LINK = re.compile(r"<a\b[^>]*>|</a>|\[[^\]\n]*\]\([^)\s]*\)|(?:https?://|www\.)\S+|\b[\w-]+(?:\.[\w-]+)*\.[a-z]{2,7}(?:/\S*)?(?=[\s\"'>)\]]|$)", re.I)
#: Lines without any of these hold no link; most lines of prose are passed over at this cost.
MAYBE_LINK = re.compile(r"<a|</a|\]\(|://|www\.|[\w-]\.[A-Za-z]{2}", re.I)
WORD = re.compile(r"#?[^\W_]+(?:['’][^\W_]+)*", re.U)
#: Patterns counted on the JVM side. Signs, scripts and control characters that no page of words is made of; sums of money, as lists
#: of prices quote them; ends of sentences; capitals; what parts a list.
ODD = r"[^\t\n\r\x{20}-\x{24f}\x{2010}-\x{202f}]|[$_]{3,}"
MONEY = r"(?i)[$£] ?\d|\d[½¼¾]? ?(?:cents?|cts?|dollars?|dolls?|francs?|shillings?)\b"
SENTENCE = r"[.!?](?:\s|$)"
CAPITAL = r"\p{Lu}"
BREAK = r"[,;|*•·\n]+| - | \. "
#: Features that need the page's words one by one, and those that are counts of a pattern.
WORDWISE = (
    "n_words", "link_share", "label_share", "tag_share", "number_share", "small_share", "repeat_share", "distinct_share", "top_share",
    "keyword_stretches", "bigram_share", "spam_share",
)
COUNTED = ("sentence_rate", "capital_share", "short_piece_share", "odd_share", "money_share")
FEATURES = WORDWISE + COUNTED
#: Which of COUNTED are divided by the page's number of words.
PER_WORD = np.array([1.0, 1.0, 0.0, 0.0, 1.0])


def features(text: str) -> list[float]:
    """The numbers named in WORDWISE; shares are of the page's words. A page without words gives noughts."""
    kinds: list[str] = []  # l link, b label beside a link, t tag, n number, s small word, w other
    words: list[str] = []
    for line in re.split(r"[\r\n]+", text):
        links = LINK.findall(line) if MAYBE_LINK.search(line) else []
        rest = LINK.sub(" ", line) if links else line
        inside = [w for x in links for w in re.findall(r"\[([^\]]*)\]", x)]
        found = WORD.findall(rest) + [w for x in inside for w in WORD.findall(x)]
        beside = bool(links) and len(found) <= 4 * len(links)
        tagged = line.lstrip().startswith("#")
        for w in found:
            low = w.lower()
            words.append(low.lstrip("#"))
            kinds.append("t" if w[0] == "#" or tagged else "b" if beside else "n" if low[0].isdigit() else "s" if low in SMALL_WORDS else "w")
        for x in links:
            if not x.startswith("</"):
                words.append("")
                kinds.append("l")
    n = len(words)
    if not n:
        return [0.0] * len(WORDWISE)
    kind = Counter(kinds)
    count = Counter(w for w, k in zip(words, kinds) if k in "wbt")
    often = max(3, n * 0.02)
    repeat = sum(c for c in count.values() if c >= often)
    pairs = Counter(zip(words, words[1:]))
    bigrams = sum(c for c in pairs.values() if c >= 3)
    # stretches of a dozen words: keywords where small words are rare and the others are repeated all over the page
    spam = bad = 0
    marks, weighty = "".join(kinds), {w for w, c in count.items() if c >= often}
    for a in range(0, n, STRETCH):
        ks, ws = marks[a : a + STRETCH], words[a : a + STRETCH]
        given, small, number = ks.count("l") + ks.count("b") + ks.count("t"), ks.count("s"), ks.count("n")
        rest = [w for w, k in zip(ws, ks) if k == "w"]
        heavy = sum([w in weighty for w in rest])
        odd = len(rest) > 0 and small <= 0.3 * len(ks) and number <= 0.25 * len(ks) and heavy >= 0.45 * len(rest)
        bad += odd
        spam += given + (len(ks) - given if odd or given > 0.7 * len(ks) else 0)
    return [
        float(n), kind["l"] / n, kind["b"] / n, kind["t"] / n, kind["n"] / n, kind["s"] / n, repeat / n, len(set(words)) / n,
        max(count.values(), default=0) / n, bad / (-(-n // STRETCH)), bigrams / n, spam / n,
    ]


def counted(text: Column) -> list[Column]:
    """What COUNTED are made of, by built-in expressions: counts where PER_WORD is 1, else shares."""
    count = lambda pattern: F.regexp_count(text, F.lit(pattern))
    pieces = F.filter(F.transform(F.split(text, BREAK), F.trim), lambda p: p != "")
    short = F.size(F.filter(pieces, lambda p: F.length(p) - F.length(F.replace(p, F.lit(" "), F.lit(""))) <= 4)) / F.greatest(F.size(pieces), F.lit(1))
    odd = F.regexp_count(text, F.lit(ODD)) / F.greatest(F.length(text), F.lit(1))
    return [x.cast("double").alias(c) for x, c in zip((count(SENTENCE), count(CAPITAL), short, odd, count(MONEY)), COUNTED, strict=True)]


def votes() -> dict[str, Column]:
    """The labelling functions: 1 for spam, 0 for none, null to abstain."""
    c = F.col
    long, few_links = c("n_words") >= 40, c("link_share") + c("label_share") + c("tag_share") < 0.05
    return {
        "links": F.when(c("link_share") + c("label_share") >= 0.65, 1),
        "tags": F.when(c("tag_share") >= 0.65, 1),
        "one_word": F.when(long & (c("top_share") >= 0.15) & (c("number_share") < 0.1), 1),
        "repetition": F.when(long & (c("repeat_share") >= 0.4) & (c("small_share") < 0.15) & (c("number_share") < 0.16) & (c("sentence_rate") < 0.08), 1),
        "no_sentence": F.when(long & (c("repeat_share") >= 0.3) & (c("small_share") < 0.1) & (c("number_share") < 0.16) & (c("sentence_rate") < 0.02), 1),
        "few_words": F.when(long & (c("distinct_share") <= 0.2) & (c("number_share") < 0.1) & (c("small_share") < 0.15), 1),
        "running_text": F.when(few_links & (c("small_share") >= 0.25) & (c("top_share") < 0.1), 0),
        "figures": F.when(few_links & (c("number_share") >= 0.2), 0),
        "prices": F.when(few_links & (c("money_share") >= 0.1) & (c("small_share") >= 0.12), 0),
        "short": F.when(few_links & (c("n_words") < 12), 0),
        "other_signs": F.when(few_links & (c("odd_share") >= 0.02), 0),
    }


def weak_label() -> Column:
    """1.0 or 0.0 where every labelling function that votes says so, null where they differ or all abstain."""
    all_ = list(votes().values())
    low, high = F.least(*all_), F.greatest(*all_)
    return F.when(low == high, low.cast("double"))


def with_features(docs: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    """doc_id, host and a column for each of FEATURES; null and blank texts are left out, they are no spam."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got = pd.DataFrame(np.array([features(t) for t in pdf["text"]]).reshape(len(pdf), len(WORDWISE)), columns=list(WORDWISE))
            got[list(COUNTED)] = pdf[list(COUNTED)].to_numpy() / np.maximum(got[["n_words"]].to_numpy(), 1.0) ** PER_WORD
            yield pd.concat([pdf[["doc_id", "host"]].reset_index(drop=True), got], axis=1)

    kept = docs.select(F.col(id_col).alias("doc_id"), F.col(host_col).cast("string").alias("host"), F.col(text_col).alias("text"))
    kept = kept.where(F.col("text").rlike(r"\S")).select("*", *counted(F.col("text")))
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, host string, " + ", ".join(f"{f} double" for f in FEATURES)
    return kept.mapInPandas(run, schema)


def scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", train_rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, host, page_score, host_score, score: the chance that a page is spam, by itself, its host's, and both together.

    Every page with a text is scored; a null host is a host. The forest is fitted on at most train_rows weakly labelled
    pages, half of either kind where there are as many, drawn by a hash of the id, so the draw
    does not depend on how the table is split. Without pages of both kinds the weak labels alone decide.
    """
    pages = cut_lineage(with_features(docs, id_col, text_col, host_col).withColumn("label", weak_label()))
    sizes = {r.label: r.n for r in pages.where("label IS NOT NULL").groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    vector = array_to_vector(F.array(*[F.col(f) for f in FEATURES]))
    if len(sizes) < 2:
        judged = pages.select("doc_id", "host", F.coalesce("label", (F.col("spam_share") > 0.5).cast("double")).alias("page_score"))
    else:
        share = F.when(F.col("label") == 1.0, F.lit(min(1.0, train_rows / 2 / sizes[1.0]))).otherwise(F.lit(min(1.0, train_rows / 2 / sizes[0.0])))
        drawn = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < share * (1 << 30)
        weight = F.when(F.col("label") == 1.0, F.lit(1.0)).otherwise(F.lit(min(1.0, max(sizes[1.0], 1) * 4 / sizes[0.0])))
        sample = pages.where(F.col("label").isNotNull() & drawn).select("doc_id", vector.alias("features"), "label", weight.alias("weight"))
        # a set order and few partitions, so that the bootstrap draws the same rows each time
        sample = sample.repartition(1).sortWithinPartitions("doc_id").drop("doc_id")
        forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, weightCol="weight", subsamplingRate=0.8, featureSubsetStrategy="sqrt")
        model = forest.fit(cut_lineage(sample))
        scored = model.transform(pages.select("doc_id", "host", vector.alias("features")))
        judged = scored.select("doc_id", "host", vector_to_array("probability")[1].alias("page_score"))
    return smoothed(judged)


def smoothed(judged: DataFrame) -> DataFrame:
    """doc_id, host, page_score, host_score, score from doc_id, host and page_score. Where hosts differ by chance only, score is page_score."""
    by_host = judged.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.sum("page_score").alias("s"), F.sum(F.col("page_score") * F.col("page_score")).alias("q"))
    by_host = cut_lineage(by_host)
    t = by_host.agg(
        F.count(F.lit(1)).alias("hosts"), F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum(F.col("n") * F.col("n")).alias("nn"),
        F.sum(F.col("q") - F.col("s") * F.col("s") / F.col("n")).alias("within"), F.sum(F.col("s") * F.col("s") / F.col("n")).alias("ss"),
    ).first()
    base, prior = 0.0, None  # prior: pages of a host that weigh as much as the corpus does; none if hosts do not differ
    if t.n:
        base, v = t.s / t.n, t.within / max(1, t.n - t.hosts)
        between = (t.ss - t.s * t.s / t.n - (t.hosts - 1) * v) / max(1e-9, t.n - t.nn / t.n)
        prior = v / between if between > 0 and t.hosts > 1 else None
    host_score = F.lit(base) if prior is None else (F.col("s") + prior * base) / (F.col("n") + prior)
    hosts = by_host.select(F.col("host").alias("of"), host_score.alias("host_score"))

    def odds(p):
        q = F.least(F.greatest(p, F.lit(0.01)), F.lit(0.99))
        return F.log(q / (1 - q))

    both = judged.join(hosts, judged["host"].eqNullSafe(hosts["of"])).drop("of")
    moved = odds(F.col("page_score")) + odds(F.col("host_score")) - odds(F.lit(base))
    return both.select("doc_id", "host", "page_score", "host_score", (1 / (1 + F.exp(-moved))).alias("score"))
