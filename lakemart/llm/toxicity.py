"""Toxicity by a subsequence string kernel, Nyström landmarks and a linear support vector machine.

The kernel of two words counts their common subsequences of four symbols, gaps of up to two in all allowed, each weighted
by ``DECAY`` to the power of its spans: an inserted or missing character weakens a match and does not end it. A word's ends
are symbols too. Letters of a word close up over other characters, and single letters in a row are one word, so
``i.d.i.o.t`` and ``i d i o t`` are words like any other. Words and landmarks are normalised by what a word of their length
has in common with itself.

Training takes a bounded sample of labelled rows (``SAMPLE`` of either label, the least by hash among texts of up to
``SAMPLE_CHARS``). Of the sample's clean words, ``NEGATIVES`` (the least by hash) are trained on at first and ``HARD_NEGATIVES``
are added a round; clean landmarks are the most usual of the first ``LANDMARK_POOL`` times ``LANDMARKS``. A toxic text tells only that one of its sentences holds something toxic, so words are labelled first by how
much more often they stand in toxic texts, and then in rounds: clean words that score high are added as hard negatives,
and toxic texts without a hit give their highest word that no clean text has. A machine over landmark features is
linear in the kernel's subsequences, so it folds into a table of weights (hashed to 2^20 entries) and scoring is look-ups. A
word is a hit beyond the margin that tells sample texts apart best. A logistic curve over the number of hits, fitted on
sample texts that the machine did not see, gives the score. Copies of toxic words with a letter put in, left out or
doubled are trained on as well.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.textops import release_memory

DECAY = 0.5
REACH = 5
SAMPLE = 1000
SAMPLE_CHARS = 40_000
LANDMARKS = 320
LANDMARK_POOL = 20
NEGATIVES = 5000
HARD_NEGATIVES = 2500
PIECE_CHARS = 1 << 19
BLOCK = 1000
LOOSE = 20.0
_SLOTS = 1 << 20
_GAPS = [(a, b, c) for c in range(3, REACH + 1) for b in range(2, c) for a in range(1, b)]


def _slots(c: np.ndarray, gap: tuple[int, int, int]) -> np.ndarray:
    """The table slot of each subsequence of four symbols with these distances from its first."""
    n = max(0, len(c) - gap[2])
    code = (c[:n] << 18) | (c[gap[0] : gap[0] + n] << 12) | (c[gap[1] : gap[1] + n] << 6) | c[gap[2] :]
    return (code.astype(np.uint32) * np.uint32(2654435761)) >> np.uint32(12)


@lru_cache(maxsize=1)
def _characters() -> tuple[np.ndarray, np.ndarray]:
    """For each code point of the basic plane: its letter code (0: no letter) and whether it is white space."""
    letter, space = np.zeros(1 << 16, np.uint8), np.zeros(1 << 16, bool)
    for c in range(1 << 16):
        x = chr(c)
        if x.isspace():
            space[c] = True
        elif x.isalpha():
            low = ord(x.lower()[0])
            letter[c] = low - 96 if 97 <= low <= 122 else 27 + low % 37
    return letter, space


def _self_kernel(n: np.ndarray) -> np.ndarray:
    """The norm of a word of ``n`` different symbols."""
    total = np.zeros(len(n))
    for gap in _GAPS:
        total += np.maximum(n - gap[2], 0) * DECAY ** (2 * (gap[2] + 1))
    return np.sqrt(total)


def word_symbols(text: str) -> tuple[np.ndarray, np.ndarray]:
    """``(codes, sizes)``: the letter codes of all words, each between two zeros, one after the other, and their lengths with both."""
    letter, space = _characters()
    points = np.minimum(np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32), 0xFFFF)
    codes, blank = letter[points], space[points]
    at = np.flatnonzero(codes)
    if not len(at):
        return codes[:0], np.empty(0, np.int64)
    token = np.cumsum(blank)[at]
    starts = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
    single = np.diff(np.append(starts, len(at))) == 1
    starts = starts[~np.concatenate([[False], single[1:] & single[:-1]])]
    sizes = np.diff(np.append(starts, len(at))) + 2
    out = np.zeros(int(sizes.sum()), np.uint8)
    inner = np.ones(len(out), bool)
    ends = np.cumsum(sizes)
    inner[ends - 1] = inner[ends - sizes] = False
    out[inner] = codes[at]
    return out, sizes


def kernel_sums(codes: np.ndarray, sizes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Each word's sum of ``weights`` over its subsequences, decayed by their spans and normalised by its length."""
    if not len(sizes):
        return np.empty(0)
    c, word, sums = codes.astype(np.int32), np.repeat(np.arange(len(sizes), dtype=np.int32), sizes), np.zeros(len(codes), np.float32)
    for reach in range(3, REACH + 1):
        n = len(c) - reach
        if n > 0:
            own = np.zeros(n, np.float32)
            for gap in _GAPS:
                if gap[2] == reach:
                    own += weights[_slots(c, gap)]
            own[word[:n] != word[reach:]] = 0
            sums[:n] += own * np.float32(DECAY ** (reach + 1))
    norm = _self_kernel(sizes)
    return np.add.reduceat(sums, np.cumsum(sizes) - sizes) / np.where(norm > 0, norm, 1)


def _subsequences(word: bytes) -> tuple[np.ndarray, np.ndarray]:
    c = np.frombuffer(word, np.uint8).astype(np.int64)
    slots = [_slots(c, gap) for gap in _GAPS]
    values = [np.full(len(s), DECAY ** (gap[2] + 1)) for s, gap in zip(slots, _GAPS)]
    return np.concatenate(slots), np.concatenate(values) / _self_kernel(np.array([len(c)]))[0]


@dataclass
class Model:
    weights: np.ndarray  # for each slot of subsequences
    bias: float
    edge: float  # the margin beyond which a word is a hit
    curve: np.ndarray

    def margins(self, piece: str) -> np.ndarray:
        """The margin of each word of at least three letters."""
        codes, sizes = word_symbols(piece)
        return (kernel_sums(codes, sizes, self.weights) + self.bias)[sizes >= 5]

    def features(self, text: str | None) -> tuple[float, int]:
        """A text's highest word margin (-2 without words) and its number of hits."""
        top, hits = -2.0, 0
        for piece in _cut(text or ""):
            margins = self.margins(piece)
            if len(margins):
                top, hits = max(top, float(margins.max())), hits + int((margins > self.edge).sum())
        return top, hits

    def probability(self, tops: np.ndarray, hits: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(_design(hits, tops - self.edge) @ self.curve, -LOOSE, LOOSE)))


def _design(hits: np.ndarray, short: np.ndarray) -> np.ndarray:
    """``short``: by how much the highest margin misses the edge, from -1 to 0."""
    return np.column_stack([np.ones(len(hits)), np.clip(short, -1, 0), np.log1p(hits), np.minimum(hits, 2), np.minimum(hits, 4)])


def _cut(text: str) -> Iterator[str]:
    """The text in pieces that end at white space where there is any."""
    at = 0
    while at < len(text):
        to = at + PIECE_CHARS
        if to < len(text):
            gap = text.rfind(" ", at + 1, to)
            to = gap if gap > 0 else to
        yield text[at:to]
        at = to


def _svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = 1e-3) -> np.ndarray:
    """A linear machine with squared hinge loss, by Newton steps; the last coefficient is the bias, as the last column of ``x`` is 1."""
    beta, ridge = np.zeros(x.shape[1]), penalty * weight.sum() * np.eye(x.shape[1])
    ridge[-1, -1] *= 1e-3
    for _ in range(25):
        active, gram, moment = np.flatnonzero(y * (x @ beta.astype(x.dtype)) < 1), ridge.copy(), np.zeros(x.shape[1])
        for at in range(0, len(active), BLOCK):
            rows = active[at : at + BLOCK]
            some = x[rows].astype(np.float64)
            own = some * weight[rows, None]
            gram += own.T @ some
            moment += own.T @ y[rows]
        step = np.linalg.solve(gram, moment)
        if np.abs(step - beta).max() < 1e-7:
            break
        beta = step
    return beta


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    beta = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (weight * (y - p)) - 1e-2 * beta
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(len(beta))
        beta = beta + np.clip(np.linalg.solve(curve, slope), -3, 3)
    return beta


def train(
    texts: list[str], toxic: np.ndarray, shares: tuple[float, float], landmarks: int = LANDMARKS, rounds: int = 3,
    negatives: int = NEGATIVES, hard_negatives: int = HARD_NEGATIVES, landmark_pool: int = LANDMARK_POOL,
) -> Model:
    """A model from sample texts. ``shares``: the weight of a clean and of a toxic text, which restores the labels' true shares.

    ``negatives`` clean words are trained on at first and at most ``hard_negatives`` more a round; clean landmarks come from the
    first ``landmark_pool`` times ``landmarks`` clean words. These bound the driver's memory.
    """
    number: dict[bytes, int] = {}
    words = []
    for text in texts:
        own: dict[bytes, None] = {}
        for piece in _cut(text):
            codes, sizes = word_symbols(piece)
            raw, ends = codes.tobytes(), np.cumsum(sizes)
            own |= dict.fromkeys(raw[e - s : e] for e, s in zip(ends.tolist(), sizes.tolist()) if 5 <= s <= 42)
        words.append(np.fromiter((number.setdefault(w, len(number)) for w in own), np.int32, len(own)))
    every = list(number)
    held = np.arange(len(texts)) % 10 >= 7
    n_toxic, n_clean = int((toxic[~held] == 1).sum()), int((toxic[~held] == 0).sum())
    blank = Model(np.zeros(_SLOTS, np.float32), -1.0, 0.0, np.array([np.log((shares[1] * n_toxic + 0.5) / (shares[0] * n_clean + 0.5)), 0, 0, 0, 0]))
    if not n_toxic or not n_clean:
        return blank
    seen = np.zeros((2, len(every)))  # clean and toxic texts that hold each word
    for own, label in zip([w for w, h in zip(words, held) if not h], toxic[~held].tolist()):
        seen[label, own] += 1
    ratio = np.where(seen[1] > 0, (seen[1] + 0.5) / (n_toxic + 1) / ((seen[0] + 0.5) / (n_clean + 1)), 0)
    bad = (ratio >= 6) & (seen[1] >= max(3, n_toxic // 300))
    if not bad.any():
        return blank
    draw = np.fromiter((zlib.crc32(w) for w in every), np.int64, len(every))
    plain = np.flatnonzero((seen[0] > 0) & ~bad & (ratio < 3))
    plain = plain[np.argsort(draw[plain], kind="stable")]
    negative = np.zeros(len(every), bool)
    negative[plain[:negatives]] = True
    marks = np.flatnonzero(bad)
    marks = marks[np.argsort(-seen[1, marks], kind="stable")][: landmarks // 2]
    usual = plain[: landmark_pool * landmarks]
    marks = np.concatenate([marks, usual[np.argsort(-seen[0, usual], kind="stable")][: landmarks - len(marks)]])
    model = blank
    for turn in range(rounds):
        parts = [_subsequences(every[w]) for w in marks]
        used, place = np.unique(np.concatenate([p for p, _ in parts]), return_inverse=True)
        table, at = np.zeros((len(used) + 1, len(marks)), np.float32), 0
        for k, (slots, values) in enumerate(parts):
            np.add.at(table[:, k], place[at : at + len(slots)], values)
            at += len(slots)
        kernel = _kernel([every[w] for w in marks], used, table).astype(np.float64)
        value, vector = np.linalg.eigh((kernel + kernel.T) / 2)
        strong = value > 1e-6 * value.max()
        root = vector[:, strong] / np.sqrt(value[strong])
        bent = sorted({v for w in np.flatnonzero(bad) for v in _bent(every[w])} - {w for w in number if bad[number[w]] or seen[0, number[w]]})
        chosen = np.concatenate([np.flatnonzero(bad), np.flatnonzero(negative)])
        x = _features([*(every[w] for w in chosen), *bent], used, table, root.astype(np.float32))
        y = np.concatenate([np.where(bad[chosen], 1.0, -1.0), np.ones(len(bent))])
        weight = np.concatenate([1 + np.log1p(seen[:, chosen].sum(0)), np.full(len(bent), 0.1)])
        weight /= np.where(y > 0, weight[y > 0].sum(), weight[y < 0].sum() / 4)
        beta = _svm(x, y, weight)
        weights = np.zeros(_SLOTS, np.float32)
        folded = root @ beta[:-1]
        for at in range(0, len(used), BLOCK):  # a block at a time is widened to double precision
            weights[used[at : at + BLOCK]] = table[at : min(at + BLOCK, len(used))] @ folded
        del parts, place, table, x  # before the next turn makes its own
        model = Model(weights, float(beta[-1]), 0.0, blank.curve)
        if turn == rounds - 1:
            break
        margin = np.empty(len(every))
        for at in range(0, len(every), 20_000):
            some = every[at : at + 20_000]
            sizes = np.fromiter(map(len, some), np.int64, len(some))
            margin[at : at + len(some)] = kernel_sums(np.frombuffer(b"".join(some), np.uint8), sizes, weights) + model.bias
        hard = plain[margin[plain] > -0.5]
        hard = hard[np.argsort(-margin[hard], kind="stable")][:hard_negatives]
        negative[hard] = True
        new = hard[: landmarks // 4]
        marks = np.concatenate([marks[:landmarks], new[~np.isin(new, marks)]])
        for own, label, h in zip(words, toxic.tolist(), held.tolist()):
            if label and not h and len(own) and margin[own].max() <= 0:
                best = own[margin[own].argmax()]
                if seen[1, best] >= 2 and not seen[0, best] and margin[best] > -0.5:
                    bad[best] = True
        negative &= ~bad
    some = np.flatnonzero(held) if len(set(toxic[held].tolist())) > 1 else np.arange(len(texts))
    weight, y = np.where(toxic[some] == 1, shares[1], shares[0]), toxic[some].astype(float)
    margins = [np.concatenate([model.margins(p) for p in _cut(texts[i])]) if texts[i] else np.empty(0) for i in some]
    best = None
    for edge in np.arange(-0.5, 1.0, 0.05):
        hits = np.array([int((m > edge).sum()) for m in margins])
        x = _design(hits, np.array([m.max(initial=-2.0) for m in margins]) - edge)
        curve = _logistic(x, y, weight / weight.mean())
        p = 1 / (1 + np.exp(-np.clip(x @ curve, -LOOSE, LOOSE)))
        loss = float(-(weight * np.log(np.where(y > 0, p, 1 - p))).sum())
        if best is None or loss < best[0]:
            best = (loss, float(edge), curve)
    model.edge, model.curve = best[1:]
    return model


def _bent(word: bytes) -> list[bytes]:
    """Four copies of a word of at least four letters, each with one letter put in, left out or doubled."""
    inner, out = word[1:-1], []
    for k in range(4 if len(inner) >= 4 else 0):
        draw = zlib.crc32(bytes([k]) + word)
        at = 1 + draw % (len(inner) - 1)
        extra = (inner[at : at + 1], b"", bytes([1 + draw // 64 % 26]), bytes([1 + draw // 4096 % 26]))[k]
        out.append(b"\0" + inner[:at] + extra + inner[at + (k == 1) :] + b"\0")
    return out


def _kernel(words: list[bytes], used: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Kernel values of words with the landmarks of ``table``, whose rows are the slots ``used`` and one of zeros."""
    out = np.zeros((len(words), table.shape[1]), np.float32)
    for k, word in enumerate(words):
        slots, values = _subsequences(word)
        at = np.minimum(np.searchsorted(used, slots), len(used) - 1)
        out[k] = values @ table[np.where(used[at] == slots, at, len(used))]
    return out


def _features(words: list[bytes], used: np.ndarray, table: np.ndarray, root: np.ndarray) -> np.ndarray:
    """The words' landmark features and a last column of ones, made a block at a time: nothing else of that size is held."""
    out = np.ones((len(words), root.shape[1] + 1), np.float32)
    for at in range(0, len(words), BLOCK):
        out[at : at + BLOCK, :-1] = _kernel(words[at : at + BLOCK], used, table) @ root
    return out


def held_out(id_col: str = "doc_id"):
    """Whether a row is kept from training: one in five, by its id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def fit(
    docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    negatives: int = NEGATIVES, hard_negatives: int = HARD_NEGATIVES, landmark_pool: int = LANDMARK_POOL,
) -> Model:
    """A model from labelled rows that are not held out.

    Rows without id, label 0 or 1, or text are not learnt from, nor are texts over ``SAMPLE_CHARS``. Of the others at most
    ``sample`` different (id, text) of either label reach the driver. ``negatives``, ``hard_negatives`` and ``landmark_pool``
    are those of ``train``.
    """
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).where("id is not null and y in (0, 1)")
    known = known.where(~held_out("id"))
    total = known.agg(*(F.count_if(F.col("y") == y) for y in (0, 1))).first()
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(F.col(text_col)).alias("key"))
    source = source.where(F.col("id").isNotNull() & F.length("text").between(1, SAMPLE_CHARS))
    usable = source.select("id", "key").distinct().join(known.distinct(), "id")  # ids may repeat on both sides
    picked = None
    for y in (0, 1):
        some = usable.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id", "key").limit(sample)
        picked = some if picked is None else picked.unionByName(some)
    found = source.join(F.broadcast(picked), ["id", "key"]).dropDuplicates(["id", "key", "y"])
    # Put in order here: a sort in Spark reads the sample twice and sends its texts to the driver for bounds as well.
    rows = sorted(found.select(F.xxhash64("id"), "text", "y").collect())
    texts, toxic = [r["text"] for r in rows], np.array([r["y"] for r in rows], np.int64)
    del rows
    shares = [total[y] / max(1, int((toxic == y).sum())) for y in (0, 1)]
    model = train(texts, toxic, (shares[0], shares[1]), negatives=negatives, hard_negatives=hard_negatives, landmark_pool=landmark_pool)
    del texts
    release_memory()
    return model


def score(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "toxicity", top_col: str = "top_margin", hits_col: str = "toxic_words") -> DataFrame:
    """``docs`` with the probability of label 1, the highest word margin and the number of toxic words added or replaced.

    Null and empty texts get the score of a text without words. Rows are scored one by one, so repeated rows agree and an
    empty table stays empty. A text of any length is read whole, piece by piece.
    """

    @F.pandas_udf("score double, top double, hits long")
    def judged(texts: pd.Series) -> pd.DataFrame:
        tops, hits = np.empty(len(texts)), np.empty(len(texts), np.int64)
        for i, text in enumerate(texts):
            tops[i], hits[i] = model.features(text)
        release_memory()
        return pd.DataFrame({"score": model.probability(tops, hits), "top": tops, "hits": hits})

    answer = docs.withColumn("__judged", judged(F.col(text_col).cast("string")))
    return answer.withColumns({
        score_col: F.col("__judged.score"), top_col: F.col("__judged.top"), hits_col: F.col("__judged.hits")
    }).drop("__judged")
