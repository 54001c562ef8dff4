"""Problem 2: texts that lost their end, and how often each source cuts.

Two sources of evidence are combined for every text that doesn't end in a full stop.

Length. Per source, the lengths (code points, and bytes) are fitted by maximum likelihood with a mixture of
``PARTS`` log-normal distributions that is right-censored at candidate limits: texts cut there count as "this long
or longer". From the fit follows how many texts without a final stop should stand at a length; where
significantly more do, at one length or in ``2 * NEAR + 1`` neighbours (a limit that is kept by cutting at the last blank
before it spreads its texts below), that is a candidate limit, and the censoring posterior of a text there is the
share of them that the fitted density doesn't explain. These are the censored counts of the next fit, until the candidates
stay as they are. Elsewhere texts may have been cut in
transfer: the share of such texts among the open ones is estimated per source by expectation
maximisation over the ending evidence, apart for texts with and without a mark of the cut.

Ending. A logistic model says how much likelier an ending is inside a text than at its end. It is
fitted on a bounded sample (``TRAIN`` texts that end in a full stop): the whole text without its stop is
an end, the same text cut at a random place is not. Its features are the last words, how common the last one
is, the frame of frequent words of the last sentence, and their combinations; it knows no list of words.
How many texts hold a word is counted over all closed texts; the last words of the scored ones are joined with it.

A text is truncated if prior and ending evidence together make a cut likelier than not. Null and blank
texts are no case and count in no share. A text delivered twice counts once (of different copies the
least). A null source is a source. A source or table without open texts gives no case.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shotlake.llm.canon import canonical_col
from shotlake.plans.lineage import cut

#: Texts that the ending model is fitted on, at most; the corpus statistics use all rows.
TRAIN = 8000
#: Log-normal distributions of a source's lengths; neighbours on either side that share a limit; how surely (log-likelihood ratio) a pile is none of the fit's.
PARTS, NEAR, SURE = 5, 3, 12.0
#: Frequent words that make the frame of a sentence.
FRAME = 80
BITS = 18
_CLOSED = "[.!?。]['\"”’)\\]]*\\s*$"
_MARK = re.compile("(?:\\.\\.+|[…,;:\\-–—(\\[“‘\"'�\\s])+$")
_TOKEN = re.compile(r"[^\W\d_]+|\d+|,")


def split_mark(text: str) -> tuple[str, int]:
    """The text without what a cut may have left, and the kind of mark: 0 none, 1 a sign, 2 half a character."""
    m = _MARK.search(text)
    if not m or not m.group().strip():
        return text.rstrip(), 0
    return text[: m.start()], 2 if "�" in m.group() else 1


def _sentence(text: str) -> list[str]:
    last = re.split(r"[.!?]\s|\n", text)[-1]
    return ["0" if t.isdigit() else t for t in _TOKEN.findall(last.casefold())]


def _body(text: str) -> str:
    """A closed text without its stop."""
    return re.sub(r"[.!?。]+['\"”’)\]]*\s*$", "", text)


def last_word(text: str) -> str:
    return (["^", *_sentence(text)])[-1]


def word_counts(closed: DataFrame) -> DataFrame:
    """word, n: how many of all texts closed(canon) hold a word; the empty word counts the texts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for t in batches:
            c = Counter({"": len(t)})
            for b in map(_body, t["canon"]):
                c.update(set(_sentence(b)) | set(_TOKEN.findall(b.casefold())))
            yield pd.DataFrame({"word": list(c), "n": list(c.values())})

    return closed.select("canon").mapInPandas(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


#: How common a word is: 0 to 3, from 3, 15 and 63 texts on.
_LEVEL = "CASE WHEN n < 3 THEN 0 WHEN n < 15 THEN 1 WHEN n < 63 THEN 2 ELSE 3 END"


def examples(whole: list[str], rng: np.random.Generator) -> list[tuple[str, float]]:
    """Texts with 0 for an end and 1 for a cut, of texts that end in a full stop."""
    out = []
    for b in filter(None, map(_body, whole)):
        out.append((b, 0.0))
        for word in (False, True):
            n = int(rng.integers(len(b) // 4, len(b))) if len(b) > 4 else 0
            if word:
                n = b.rfind(" ", 0, n)
            if n > 0 and b[n] not in ".!?" and split_mark(b[:n])[0][-1:] not in (".", ""):
                out.append((split_mark(b[:n])[0], 1.0))
    return out


class Endings:
    """The ending model: ``score`` is the log-odds of a place inside a text against its end."""

    def __init__(self, made: list[tuple[str, float]], frame: set[str], level: dict[str, int], rng: np.random.Generator):
        self.frame = frame
        self.w = np.zeros(1 << BITS, np.float32)
        if made:
            self._fit([self._features(x, level.get(last_word(x), 0)) for x, _ in made], np.array([y for _, y in made], np.float32), rng)

    def _features(self, text: str, rare: int) -> np.ndarray:
        s = _sentence(text)
        w1, w2, w3 = ([*s[::-1], "^", "^", "^"])[:3]
        a, b = ([*s, "$", "$"])[:2]
        sk = [w for w in s if w in self.frame]
        k1, k2 = ([*sk[::-1], "^", "^"])[:2]
        back = s[::-1]
        num = back.index("0") if "0" in back else 9
        com = back.index(",") if "," in back else 9
        f = ["b", f"1{w1}", f"2{w2} {w1}", f"3{w3} {w2} {w1}", f"a{a}|{w1}", f"ab{a} {b}|{w1}", f"k{k1}|{w1}", f"kk{k2} {k1}|{w1}", f"n{min(num, 6)}|{a}", f"c{min(com, 9)}|{a}"]
        f += [f"nc{min(num, 6)}|{min(com, 9)}|{a} {b}", f"r{rare}", f"l{min(len(s), 40)}", f"K{k2} {k1}", f"a2{a}|{w2} {w1}", f"N{min(num, 6)}|{w2} {w1}"]
        f += [f"s{x}|{w1}" for x in set(sk)] + [f"z{x}|{min(num, 4)}" for x in set(sk)]
        return np.array([zlib.crc32(x.encode()) & ((1 << BITS) - 1) for x in f], np.int64)

    def _fit(self, x: list[np.ndarray], y: np.ndarray, rng: np.random.Generator) -> None:
        weight = np.where(y > 0, len(y) / (2 * max(1, y.sum())), len(y) / (2 * max(1, (1 - y).sum()))).astype(np.float32)
        size = np.array([len(f) for f in x])
        flat = np.concatenate(x)
        at = np.r_[0, np.cumsum(size)]
        g2 = np.full(1 << BITS, 1e-6, np.float32)
        for _ in range(6):
            order = rng.permutation(len(x))
            for i in range(0, len(order), 256):
                rows = order[i : i + 256]
                idx = np.concatenate([flat[at[r] : at[r + 1]] for r in rows])
                n = size[rows]
                z = np.add.reduceat(self.w[idx], np.r_[0, np.cumsum(n)[:-1]])
                err = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[rows]) * weight[rows]
                where, inv = np.unique(idx, return_inverse=True)
                g = np.bincount(inv, np.repeat(err, n)).astype(np.float32) / 16 + 1e-5 * self.w[where]
                g2[where] += g * g
                self.w[where] -= 0.3 * g / np.sqrt(g2[where])

    def score(self, text: str, rare: int) -> float:
        return float(np.clip(self.w[self._features(text, rare)].sum(), -12, 12))


def _phi(z: np.ndarray) -> np.ndarray:
    return np.exp(-z * z / 2) / np.sqrt(2 * np.pi)


def _upper(z: np.ndarray) -> np.ndarray:
    """Upper tail of the normal distribution (Abramowitz and Stegun 26.2.17)."""
    t = 1 / (1 + 0.2316419 * np.abs(z))
    p = _phi(z) * t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    return np.clip(np.where(z >= 0, p, 1 - p), 1e-12, 1)


def fit_mixture(length: np.ndarray, exact: np.ndarray, censored: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """share, mu, sigma of the log-normals whose mixture maximises the likelihood of exact and right-censored counts by length (EM)."""
    x = np.log(np.maximum(length, 1).astype(float))
    n = exact + censored
    total = n.sum()
    if not total:
        return np.full(parts, 1 / parts), np.zeros(parts), np.ones(parts)
    order = np.argsort(x, kind="stable")
    mu = x[order][np.minimum(np.searchsorted(np.cumsum(n[order]) / total, (np.arange(parts) + 0.5) / parts), len(x) - 1)]
    mean = (x * n).sum() / total
    sd = np.full(parts, max(0.05, float(np.sqrt(((x - mean) ** 2 * n).sum() / total)) / (1 if parts == 1 else 2)))
    share = np.full(parts, 1 / parts)
    for _ in range(50 if parts == 1 else 100):
        z = (x[:, None] - mu) / sd
        phi, tail = _phi(z), _upper(z)
        a = share * phi / sd + 1e-300
        b = share * tail
        a *= exact[:, None] / a.sum(1, keepdims=True)
        b *= censored[:, None] / np.maximum(b.sum(1, keepdims=True), 1e-300)
        ratio = phi / tail
        m1 = mu + sd * ratio
        m2 = mu * mu + sd * sd + sd * (x[:, None] + mu) * ratio
        weight = np.maximum((a + b).sum(0), 1e-9)
        mu = (a * x[:, None] + b * m1).sum(0) / weight
        sd = np.maximum(0.05, np.sqrt(np.maximum(1e-9, (a * x[:, None] ** 2 + b * m2).sum(0) / weight - mu * mu)))
        share = weight / weight.sum()
    return share, mu, sd


def fit_censored(length: np.ndarray, exact: np.ndarray, censored: np.ndarray) -> tuple[float, float]:
    """mu, sigma of the one log-normal that maximises the likelihood."""
    _, mu, sd = fit_mixture(length, exact, censored, 1)
    return float(mu[0]), float(sd[0])


def _piled(observed: np.ndarray, expected: np.ndarray) -> np.ndarray:
    """Posterior of an observed value to be none of those expected, 0 unless the excess is significant."""
    surely = observed * np.log(np.maximum(observed, 1e-9) / expected) - (observed - expected) > SURE
    return np.where(surely & (observed > expected), np.clip(1 - expected / np.maximum(observed, 1e-9), 0, 0.995), 0)


def find_limits(length: np.ndarray, closed: np.ndarray, open_: np.ndarray, spread: bool) -> list[tuple[int, float]]:
    """(length, censoring posterior of an open value there) of one source's histogram, ``spread``: also of limits kept at blanks."""
    if not closed.sum() or not open_.sum():
        return []
    place = length - length.min()
    around = np.ones(2 * NEAR + 1)

    def near(v: np.ndarray) -> np.ndarray:
        full = np.zeros(int(place.max()) + 1)
        full[place] = v
        return np.convolve(full, around, "full")[NEAR : NEAR + len(full)][place]

    post = np.zeros(len(length))
    for _ in range(6):
        exact, censored = closed + open_ * (1 - post), open_ * post
        share, mu, sd = fit_mixture(length, exact, censored, PARTS)
        z = (np.log(np.maximum(length, 1))[:, None] - mu) / sd
        density = (share * _phi(z) / sd).sum(1) / np.maximum(length, 1)
        # Of the texts that end by themselves, those without a stop.
        expected = (exact.sum() + censored.sum()) * density * (open_ * (1 - post)).sum() / exact.sum() + 1e-6
        new = np.where(open_ >= 6, _piled(open_, expected), 0)
        if spread:
            rest = np.where(new > 0.5, 0, open_)
            wide = np.minimum(_piled(near(rest), near(np.where(new > 0.5, 0, expected)) + 1e-6), 0.95)
            new = np.where(new > 0.5, new, wide)
        new = np.where((new > 0.5) & (open_ > 0), new, 0)
        same = ((new > 0) == (post > 0)).all()
        post = new
        if same:
            break
    return [(int(v), float(p)) for v, p in zip(length, post) if p > 0]


def _limits(pdf: pd.DataFrame) -> pd.DataFrame:
    rows = []
    for measure, t in pdf.groupby("measure"):
        t = t.sort_values("len")
        n_open = t["n_open"].to_numpy(float)
        rows += [(pdf["src"].iloc[0], measure, *x) for x in find_limits(t["len"].to_numpy(), t["n"].to_numpy(float) - n_open, n_open, measure == "chars")]
    return pd.DataFrame(rows, columns=["src", "measure", "len", "post"])


def _rates(pdf: pd.DataFrame) -> pd.DataFrame:
    """Share of cut texts among a source's open texts of one kind of mark, by EM over the binned ending evidence."""
    rows = []
    for mark, t in pdf.groupby("mark"):
        ratio, n = np.exp(t["bin"].to_numpy() / 4), t["n"].to_numpy(float)
        rate = 0.5
        for _ in range(100):
            post = rate * ratio / (rate * ratio + 1 - rate)
            rate = float(np.clip((n * post).sum() / n.sum(), 0.01, 0.99))
        rows.append((pdf["src"].iloc[0], mark, rate))
    return pd.DataFrame(rows, columns=["src", "mark", "rate"])


def _split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for t in batches:
        parts = [split_mark(x) for x in t.pop("canon")]
        yield t.assign(mark=[m for _, m in parts], body=[x for x, _ in parts], word=[last_word(x) for x, _ in parts])


def _scored(model: Endings):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for t in batches:
            yield t[["id", "src", "chars", "bytes", "mark"]].assign(score=[model.score(x, r) for x, r in zip(t["body"], t["rare"])])

    return run


def _texts(df: DataFrame, key: str, source: str, text: str) -> DataFrame:
    t = df.select(F.col(key).alias("id"), F.col(source).alias("src"), F.col(text).alias("text")).where(F.col("id").isNotNull())
    t = t.groupBy("id").agg(F.min(F.struct("src", "text")).alias("x")).select("id", F.coalesce("x.src", F.lit("")).alias("src"), "x.text")
    return t.where(F.trim(F.regexp_replace("text", "\\s+", " ")) != "").select("id", "src", "text", canonical_col(F.col("text")).alias("canon"))


def _measured(t: DataFrame) -> DataFrame:
    """id, src, canon, open, chars, bytes of the texts, each brought to its form once."""
    open_ = ~F.col("canon").rlike(_CLOSED) | F.col("canon").rlike("\\.\\.+\\s*$")
    # What half a character was is lost; it stood for one byte at least of the limit's.
    whole = F.regexp_replace("text", "�+$", "")
    size = F.octet_length(whole) + F.when(F.length(whole) < F.length("text"), 1).otherwise(0)
    return cut(t.select("id", "src", "canon", open_.alias("open"), F.length("text").alias("chars"), size.alias("bytes")))


def _posteriors(t: DataFrame) -> DataFrame:
    """id, src, posterior of the open texts of t, as measured."""
    closed = t.where(~F.col("open")).select("canon")
    counts = cut(word_counts(closed))
    n = next((r["n"] for r in counts.where("word = ''").collect()), 0)
    if n > TRAIN:
        closed = closed.sample(False, min(1.0, 1.1 * TRAIN / n), 9).limit(TRAIN)
    rng = np.random.default_rng(3)
    made = examples([r[0] for r in closed.collect()], rng)
    frame = {r["word"] for r in counts.where("word <> ''").orderBy(F.desc("n"), "word").limit(FRAME).collect()}
    common = counts.where("n >= 3 and word <> ''").select("word", F.expr(_LEVEL).alias("rare"))
    needed = t.sparkSession.createDataFrame([(w,) for w in {last_word(x) for x, _ in made}], "word string")
    model = Endings(made, frame, {r["word"]: r["rare"] for r in common.join(F.broadcast(needed), "word").collect()}, rng)
    kind = dict(t.dtypes)["id"]
    scored = t.where("open").select("id", "src", "chars", "bytes", "canon").mapInPandas(_split, f"id {kind}, src string, chars int, bytes int, mark int, body string, word string")
    scored = scored.join(common, "word", "left").fillna(0, ["rare"])
    scored = scored.mapInPandas(_scored(model), f"id {kind}, src string, chars int, bytes int, mark int, score double")
    scored = cut(scored)
    hist = t.select("src", "open", F.explode(F.map_from_arrays(F.array(F.lit("chars"), F.lit("bytes")), F.array("chars", "bytes"))).alias("measure", "len"))
    hist = hist.groupBy("src", "measure", "len").agg(F.count("*").alias("n"), F.count_if("open").alias("n_open"))
    limits = hist.groupBy("src").applyInPandas(_limits, "src string, measure string, len int, post double")
    limits = cut(limits)
    at = lambda m: limits.where(F.col("measure") == m).select("src", F.col("len").alias(m), F.col("post").alias(f"{m}_post"))
    scored = scored.join(at("chars"), ["src", "chars"], "left").join(at("bytes"), ["src", "bytes"], "left").withColumn("prior", F.greatest("chars_post", "bytes_post"))
    bins = scored.where("prior is null").groupBy("src", "mark", F.round(F.col("score") * 4).cast("int").alias("bin")).agg(F.count("*").alias("n"))
    rates = bins.groupBy("src").applyInPandas(_rates, "src string, mark int, rate double")
    scored = scored.join(rates, ["src", "mark"], "left")
    prior = F.when(F.col("mark") == 2, F.lit(0.999)).otherwise(F.coalesce("prior", "rate", F.lit(0.5)))
    odds = F.log(prior / (1 - prior)) + F.col("score")
    return scored.select("id", "src", (1 / (1 + F.exp(-odds))).alias("posterior"))


def truncated(df: DataFrame, key: str, source: str, text: str) -> DataFrame:
    """id, posterior of the texts that were cut."""
    return _posteriors(_measured(_texts(df, key, source, text))).where("posterior > 0.5").select("id", "posterior")


def truncation_share(df: DataFrame, key: str, source: str, text: str) -> DataFrame:
    """source, n_texts, n_truncated, share. A null source is listed as the empty one."""
    t = _measured(_texts(df, key, source, text))
    n = t.groupBy("src").agg(F.count("*").alias("n_texts"))
    c = _posteriors(t).groupBy("src").agg(F.count_if(F.col("posterior") > 0.5).alias("n_truncated"))
    out = n.join(c, "src", "left").withColumn("n_truncated", F.coalesce("n_truncated", F.lit(0)).cast("bigint"))
    return out.select(F.col("src").alias("source"), "n_texts", "n_truncated", (F.col("n_truncated") / F.col("n_texts")).alias("share"))
