"""Toxicity by a subsequence-kernel support vector machine with Nyström landmarks (operator 5).

The kernel compares two spans of text by the subsequences of four characters that they share, gaps included; a
subsequence over s characters weighs DECAY ** (s - 4). Signs are dropped, the beginning of a word is a character of its own, and letters that
stand alone one after the other are joined. So an insult with letters put in or left out, cut by a space or glued to an
ending stays near its plain form.

The example is a sentence, with its document's label. A sentence scores as its best span, which is a word or two
words in a row: that of a toxic sentence is not known, so the machine is trained in rounds. First the words that
toxic documents have and clean ones lack stand for their sentences, then the words that score best there; each of them comes with
VARIANTS copies that have a letter or a space put in. Against them stand words and pairs of words of clean sentences, above all those that
look most toxic. Landmarks are spans of both kinds; the Nyström map of the kernel at the landmarks feeds a linear
machine with squared hinge loss. As the kernel is a product of subsequence counts, the trained machine folds into one
weight for each hashed subsequence (2 ** HASH_BITS numbers). Adding these along a text gives the scores of all its spans at once.

Training reads at most ``sample`` documents of each label, none longer than TRAIN_CHARS, in one task; only the weights come to
the driver. A document's score is a logistic function of the score of its best sentence, fitted on training documents kept
apart: as they are, with a letter, sign or space put into their words, and toxic ones also as one such sentence alone.
Every text is scored whole; a very long one in pieces that overlap by a word. Null and empty texts, and texts without letters, have
the score of no evidence; without labels of both kinds every score is 0; of documents that share an id training reads the least
text; repeated rows are scored each; ties of words or documents are settled by their order in the sample, which is that of a hash of
the ids; an empty table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartlift.llm.common import map_texts, rewrite_texts, texts_of
from chartlift.llm.labels import held_out, training_labels

SAMPLE = 1500  # documents of each label that training reads at most
LANDMARKS = 300
ROUNDS = 3
HASH_BITS = 20
DECAY = 0.8
SPAN = 7
NEGATIVE_WORDS = 12_000
COST = 20.0
TRAIN_CHARS = 100_000
WITNESSES = 3  # sentences of a toxic document that are learned from
VARIANTS = 16  # copies of a toxic word with something put in
CHUNK_CHARS = 400_000  # of texts that are scored at once
SURE = 4.0  # standard deviations by which a word is more frequent in toxic documents
CUT = 0.5
MARK = ord("^")  # the beginning of a word

_PATTERNS = [(j, k, m) for m in range(3, SPAN) for k in range(2, m) for j in range(1, k)]
_BLANK = re.compile(r"\s")
_SINGLE = re.compile(r"(?<!\S)(?:\S\s){2,}\S(?!\S)")


@lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    """For every code point: 1 for letters, 2 for blanks."""
    points = map(chr, range(0x110000))
    return np.fromiter((1 if c.isalpha() else 2 if c.isspace() else 0 for c in points), np.uint8, 0x110000)


@dataclass
class Stream:
    """The letters of some texts, with a mark before each word, and where words begin and end."""

    codes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    sentence: np.ndarray  # of each word; sentences of different texts differ
    text: np.ndarray  # of each word

    def words(self) -> list[str]:
        joined = self.codes.astype("<u4").tobytes().decode("utf-32-le")
        return [joined[a:b] for a, b in zip(self.starts.tolist(), self.ends.tolist(), strict=True)]


def stream_of(texts: list[str]) -> Stream:
    joined = [f"{t}\n" + "".join(f"{''.join(m.group().split())}\n" for m in _SINGLE.finditer(t)) for t in map(str.lower, texts)]
    codes = np.frombuffer("".join(joined).encode("utf-32-le"), dtype=np.uint32)
    kind = _kinds()[codes]
    text = np.repeat(np.arange(len(texts)), list(map(len, joined)))
    stop = (codes == ord(".")) | (codes == ord("!")) | (codes == ord("?"))
    stop[:-1] &= kind[1:] == 2
    sentence = np.cumsum(stop | (codes == 10))
    place = np.flatnonzero(kind)
    kept = kind[place]
    begins = (kept == 1) & np.concatenate([[True], kept[:-1] == 2])[: len(kept)]  # a letter behind a blank, signs apart
    letter = kept == 1
    width = letter.astype(np.int64) + begins  # a mark goes before the first letter
    at = np.cumsum(width)
    out = np.full(int(at[-1]) if len(at) else 0, MARK, dtype=np.uint64)
    out[at[letter] - 1] = codes[place[letter]]
    starts = at[begins] - 2
    return Stream(out, starts, np.append(starts[1:], len(out)) if len(starts) else starts, sentence[place[begins]], text[place[begins]])


def _keys(codes: np.ndarray, j: int, k: int, m: int, at: np.ndarray | None = None) -> np.ndarray:
    """The hashed subsequences at offsets 0, j, k, m from ``at``, or from everywhere."""
    n = len(codes) - m
    key = codes[:n] if at is None else codes[at]
    for offset in (j, k, m):
        key = key * np.uint64(0x9E3779B97F4A7C15) + (codes[offset : n + offset] if at is None else codes[at + offset])
    key ^= key >> np.uint64(29)
    return ((key * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - HASH_BITS)).astype(np.int64)


def subsequences(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(span number, hashed subsequence, weight) of all spans; each span's weights have norm 1."""
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    codes = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(words)), lengths)
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(codes))  # letters from here to the word's end
    owners, keys, weights = [], [], []
    for j, k, m in _PATTERNS:
        at = np.flatnonzero(left > m)
        keys.append(_keys(codes, j, k, m, at))
        owners.append(owner[at])
        weights.append(np.full(len(at), DECAY ** (m - 3)))
    number, key, weight = np.concatenate(owners), np.concatenate(keys), np.concatenate(weights)
    norms = np.sqrt(np.bincount(number, weights=weight**2, minlength=len(words)))
    return number, key, weight / np.maximum(norms[number], 1e-9)


@dataclass
class Model:
    weights: np.ndarray  # of hashed subsequences
    bias: float
    curve: np.ndarray  # of the highest score and 1

    def spans(self, stream: Stream) -> tuple[np.ndarray, np.ndarray]:
        """The scores of each word, and of each word with the next of its sentence (minus infinity at a sentence's end)."""
        codes = stream.codes
        one, two = np.zeros(len(stream.starts)), np.zeros(len(stream.starts))
        norm_one, norm_two = np.zeros(len(one)), np.zeros(len(one))
        further = np.append(stream.ends[1:], stream.ends[-1:])
        for m in range(3, SPAN):
            patterns = [p for p in _PATTERNS if p[2] == m]
            added = np.zeros(len(codes) + 1)
            if len(codes) > m:
                for pattern in patterns:
                    added[1 : len(codes) - m + 1] += self.weights[_keys(codes, *pattern)]
            added = np.cumsum(added) * DECAY ** (m - 3)
            for ends, score, norm in ((stream.ends, one, norm_one), (further, two, norm_two)):
                score += added[np.maximum(ends - m, stream.starts)] - added[stream.starts]
                norm += np.maximum(ends - stream.starts - m, 0) * len(patterns) * DECAY ** (2 * m - 6)
        one = one / np.sqrt(np.maximum(norm_one, 1e-9)) + self.bias
        two = two / np.sqrt(np.maximum(norm_two, 1e-9)) + self.bias
        two[np.append(stream.sentence[1:] != stream.sentence[:-1], True)[: len(two)]] = -np.inf
        return one, two

    def evidence(self, texts: list[str]) -> np.ndarray:
        """What the spans of each text say about it."""
        stream = stream_of(texts)
        out = np.tile([self.bias, 1.0], (len(texts), 1))
        if len(stream.starts):
            np.maximum.at(out[:, 0], stream.text, np.maximum(*self.spans(stream)))
        return out

    def probability(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(evidence @ self.curve, -50, 50)))


def _landmark_map(landmarks: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(subsequences in use, their weights in each landmark, the inverse root of the landmarks' kernel matrix)."""
    number, key, weight = subsequences(landmarks)
    used, place = np.unique(key, return_inverse=True)
    table = np.zeros((len(used), len(landmarks)))
    np.add.at(table, (place, number), weight)
    values, vectors = np.linalg.eigh(table.T @ table)
    kept = values > 1e-3 * max(values.max(), 1e-9)
    return used, table, vectors[:, kept] / np.sqrt(values[kept])


def _nystroem(spans: list[str], used: np.ndarray, table: np.ndarray, root: np.ndarray) -> np.ndarray:
    out = np.zeros((len(spans), root.shape[1]), dtype=np.float32)
    folded = (table @ root).astype(np.float32)
    for start in range(0, len(spans), 500):
        number, key, weight = subsequences(spans[start : start + 500])
        place = np.searchsorted(used, key)
        place[place == len(used)] = 0
        known = np.flatnonzero(used[place] == key)
        known = known[np.argsort(number[known], kind="stable")]
        if len(known):
            owner = number[known]
            first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            out[start + owner[first]] = np.add.reduceat(folded[place[known]] * weight[known, None].astype(np.float32), first)
    return out


def _squared_hinge(features: np.ndarray, target: np.ndarray, importance: np.ndarray, cost: float) -> tuple[np.ndarray, float]:
    """A linear machine by Newton steps on the examples inside the margin."""
    x = np.hstack([features, np.ones((len(features), 1), dtype=features.dtype)])
    w = np.zeros(x.shape[1])
    ridge = np.eye(len(w))
    ridge[-1, -1] = 1e-3
    for _ in range(30):
        inside = target * (x @ w) < 1
        xi, ci = x[inside], cost * importance[inside]
        new = np.linalg.solve(ridge + 2 * (xi * ci[:, None]).T @ xi, 2 * xi.T @ (ci * target[inside]))
        if np.abs(new - w).max() < 1e-6:
            break
        w = new
    return w[:-1], w[-1]


def _logistic(x: np.ndarray, label: np.ndarray, share: float) -> np.ndarray:
    """Coefficients of a logistic curve, slightly ridged; label 1 weighs its share of all labelled rows. Evidence never
    counts against itself.
    """
    importance = np.where(label == 1, share / max(1, (label == 1).sum()), (1 - share) / max(1, (label == 0).sum())) * len(x)
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))
        gradient = x.T @ (importance * (p - label)) + 0.01 * w
        hessian = (x * (importance * p * (1 - p))[:, None]).T @ x + 0.01 * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    w[0] = max(w[0], 1e-3)
    return w


def _top_words(bags: list[np.ndarray], scores: np.ndarray, each: int) -> np.ndarray:
    return np.concatenate([d[np.argsort(-scores[d], kind="stable")[:each]] for d in bags]) if bags else np.zeros(0, dtype=np.int64)


def altered(word: str, letters: str, rng: np.random.Generator, kinds: str = "ls") -> str:
    """A word with a letter (l), a sign (*) or a space (s) put between two of its letters."""
    place = int(rng.integers(2, len(word))) if word[0] == "^" else int(rng.integers(1, len(word)))
    kind = kinds[int(rng.integers(len(kinds)))]
    put = letters[int(rng.integers(len(letters)))] if kind == "l" else ("^" if word[0] == "^" else " ") if kind == "s" else "*"
    return word[:place] + put + word[place:]


def train(rows: list[tuple[int, str]], share: float = 0.5, landmarks: int = LANDMARKS, rounds: int = ROUNDS) -> Model | None:
    """``rows``: (label, text) of sampled documents, in an order that does not depend on the labels;
    ``share``: that of label 1 among all labelled rows.
    """
    rng = np.random.default_rng(7)
    vocabulary: dict[str, int] = {}
    streams, documents, sentences = [], [], []
    for label, text in _without_copies(rows):
        stream = stream_of([text])
        found = [(n, vocabulary.setdefault(w, len(vocabulary))) for n, w in zip(stream.sentence.tolist(), stream.words(), strict=True) if len(w) > 3]
        if found:
            number, word = np.array(found, dtype=np.int64).T
            streams.append((label, text, stream))
            documents.append(np.unique(word))
            sentences.append(np.split(word, np.flatnonzero(number[1:] != number[:-1]) + 1))
    words = list(vocabulary)
    apart = [n for n in range(len(streams)) if n % 4 == 0]  # for the logistic curve
    toxic = [n for n, (label, *_) in enumerate(streams) if label == 1 and n % 4]
    clean = [n for n, (label, *_) in enumerate(streams) if label == 0 and n % 4]
    if not toxic or not clean:
        return None
    in_toxic = np.bincount(np.concatenate([documents[n] for n in toxic]), minlength=len(words))
    in_clean = np.bincount(np.concatenate([documents[n] for n in clean]), minlength=len(words))
    shuffled = rng.permutation(np.flatnonzero(in_clean))[:NEGATIVE_WORDS]
    letters = "".join(words[i][1:] for i in shuffled[:2000])
    some_pairs = [pair for n in clean for pair in _pairs(streams[n][2], rng.integers(len(streams[n][2].starts), size=NEGATIVE_WORDS // len(clean) + 1))]
    scores = in_toxic / len(toxic) - 4 * in_clean / len(clean)
    # Only words that toxic documents have far more often, and more often than chance explains, can be to blame.
    telling = (in_toxic * len(clean) > 5 * in_clean * len(toxic)) & (in_toxic >= min(2, len(toxic)))
    both = (in_toxic + in_clean) / (len(toxic) + len(clean))
    deviation = (in_toxic / len(toxic) - in_clean / len(clean)) / np.sqrt(np.maximum(both * (1 - both) * (1 / len(toxic) + 1 / len(clean)), 1e-12))
    certain = telling & (deviation >= min(SURE, np.max(deviation, initial=0.0, where=telling)))
    model, hard, hard_pairs = None, np.zeros(0, dtype=np.int64), []
    for turn in range(rounds):
        best = [_top_words(sentences[n], np.where(certain, scores, -np.inf), 1) for n in toxic]
        positive = _top_words(list(map(np.unique, best)), np.where(certain, scores, -np.inf), WITNESSES)
        positive = positive[certain[positive]]
        if turn:
            positive = positive[scores[positive] > min(0.0, float(np.median(scores[positive])))]
            hard = np.unique(_top_words([documents[n] for n in clean], scores, 2))
            hard_pairs = [pair for n in clean for pair in _pairs(streams[n][2], np.argsort(-model.spans(streams[n][2])[1], kind="stable")[:2])]
        positive, times = np.unique(positive, return_counts=True)
        if not len(positive):
            return model
        negative = np.setdiff1d(np.union1d(shuffled, hard), positive)
        by_use = positive[np.argsort(-times, kind="stable")][: landmarks * 2 // 3]
        others = np.concatenate([hard[np.argsort(-scores[hard], kind="stable")], shuffled])
        others = others[~np.isin(others, positive)]
        chosen = [words[i] for i in [*by_use, *others[: landmarks - len(by_use)]]]
        used, table, root = _landmark_map(chosen)
        copies = [(altered(words[i], letters, rng), n) for i, n in zip(positive, times, strict=True) for _ in range(VARIANTS)]
        against = [words[i] for i in negative] + some_pairs + hard_pairs
        spans = [words[i] for i in positive] + [w for w, _ in copies] + against
        target = np.repeat([1.0, -1.0], [len(spans) - len(against), len(against)])
        importance = np.concatenate([np.sqrt(times), np.sqrt([n / VARIANTS for _, n in copies]), np.ones(len(against))])
        importance[target > 0] *= 0.6 * len(against) / max(1.0, importance[target > 0].sum())
        w, bias = _squared_hinge(_nystroem(spans, used, table, root), target, importance, COST)
        weights = np.zeros(1 << HASH_BITS, dtype=np.float32)
        weights[used] = table @ (root @ w)
        model = Model(weights, float(bias), np.array([1.0, 0.0]))
        scores = np.concatenate([_word_scores(model, words[i : i + 5000]) for i in range(0, len(words), 5000)])
    label = np.array([streams[n][0] for n in apart])
    if len(set(label.tolist())) == 2:
        def mixed(text):
            return " ".join(altered(w, letters, rng, "l*s") if len(w) > 3 else w for w in text.split(" "))

        texts = [streams[n][1] for n in apart]
        alone = []  # one sentence of each toxic document that shows what it is
        for n in np.array(apart)[label == 1]:
            best = [words[int(sentence[np.argmax(scores[sentence])])][1:] for sentence in sentences[n] if scores[sentence].max() > 0]
            alone += [mixed(best[int(rng.integers(len(best)))])] if best else []
        evidence = np.concatenate([model.evidence([t]) for t in [*texts, *map(mixed, texts), *alone]])
        model.curve = _logistic(evidence, np.concatenate([label, label, np.ones(len(alone), dtype=label.dtype)]), share)
    return model


def _without_copies(rows: list[tuple[int, str]]) -> list[tuple[int, str]]:
    """Rows that share less than half of their words with each earlier row: words of copied texts are no evidence of their own."""
    kept, met = [], {}
    for label, text in rows:
        words = frozenset(text.lower().split())
        least = sorted(zlib.crc32(w.encode()) for w in words)[:4]
        if any(2 * len(words & other) >= len(words | other) for h in least for other in met.get(h, ())):
            continue
        kept.append((label, text))
        for h in least:
            met.setdefault(h, []).append(words)
    return kept


def _pairs(stream: Stream, first: np.ndarray) -> list[str]:
    """The words at ``first``, each with the next of its sentence."""
    first = first[first + 1 < len(stream.starts)]
    first = first[stream.sentence[first] == stream.sentence[first + 1]]
    return [stream.codes[stream.starts[i] : stream.ends[i + 1]].astype("<u4").tobytes().decode("utf-32-le") for i in first]


def _word_scores(model: Model, words: list[str]) -> np.ndarray:
    number, key, weight = subsequences(words)
    return np.bincount(number, weights=weight * model.weights[key], minlength=len(words)) + model.bias


def sample_rows(docs: DataFrame, known: DataFrame, sample: int) -> DataFrame:
    """(doc_id, label, text) of at most ``sample`` training documents of each label, chosen by a hash of their ids."""
    order = F.xxhash64("doc_id")
    parts = [known.where(F.col("label") == y).orderBy(order, "doc_id").limit(sample) for y in (0, 1)]
    chosen = parts[0].unionByName(parts[1]).select("doc_id", "label")
    # At most 2 * sample ids of 16 bytes: a proven bound for the broadcast.
    rows = docs.where(F.length("text") <= TRAIN_CHARS).join(F.broadcast(chosen), "doc_id")
    return rows.groupBy("doc_id", "label").agg(F.min("text").alias("text")).withColumn("place", F.xxhash64("doc_id"))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, label_col: str = "toxic") -> Model | None:
    known = training_labels(labels, label_col)
    share = known.agg(F.avg("label")).first()[0]
    if not share:
        return None

    def run(batches):
        rows = sorted((row["place"], row["doc_id"], row["label"], row["text"]) for batch in batches for row in batch.to_pylist())
        model = train([(label, text) for *_, label, text in rows], share)
        if model is not None:
            columns = [pa.array([model.weights.astype("<f4").tobytes()]), pa.array([model.bias]), pa.array([model.curve])]
            yield pa.RecordBatch.from_arrays(columns, names=["weights", "bias", "curve"])

    # One task: the sample is bounded, and one row of 2 ** HASH_BITS numbers comes back.
    found = sample_rows(texts_of(docs), known, sample).repartition(1).mapInArrow(run, "weights binary, bias double, curve array<double>").collect()
    return Model(np.frombuffer(found[0].weights, dtype="<f4"), found[0].bias, np.array(found[0].curve)) if found else None


def _cut(text: str) -> list[str]:
    """A long text in pieces; each begins with the last word of the one before, so that no pair of words is lost."""
    parts, start = [], 0
    while len(text) - start > CHUNK_CHARS:
        end = next((m.start() for m in _BLANK.finditer(text, start + CHUNK_CHARS)), len(text))
        parts.append(text[start:end])
        start = max(text.rfind(blank, start + 1, end) for blank in " \n")
        start = end if start < 0 else start
    return [*parts, text[start:]]


class Scorer:
    """Probabilities of texts."""

    def __init__(self, model: Model | None):
        self.model = model

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        machine = self.model
        if machine is None:
            return np.zeros(len(texts))
        evidence = np.tile([machine.bias, 1.0], (len(texts), 1))
        held, chars = [], 0
        for i, text in enumerate([*texts, None]):
            if held and (i == len(texts) or chars + len(text or "") > CHUNK_CHARS):
                evidence[held] = machine.evidence([texts[j] for j in held])
                held, chars = [], 0
            if text and len(text) > CHUNK_CHARS:
                evidence[i] = np.max([machine.evidence([part])[0] for part in _cut(text)], axis=0)
            elif text:
                held.append(i)
                chars += len(text)
        return machine.probability(evidence)


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted for every text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        scorer = Scorer(shared.value)
        return lambda ids, texts: {"doc_id": ids, "score": scorer(texts)}

    found = map_texts(texts_of(docs, id_col, text_col), make, "doc_id long, score double")
    return found.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= CUT, 1).otherwise(0).alias("predicted")
    )


def without_toxic(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """The rows whose texts are not predicted to be toxic, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        scorer = Scorer(shared.value)
        return lambda texts: [False if p >= CUT else t for t, p in zip(texts, scorer(texts), strict=True)]

    return rewrite_texts(docs, make, text_col)


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    return score(docs, fit(docs, labels, sample))
