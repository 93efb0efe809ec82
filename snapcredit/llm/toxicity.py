"""Toxic spans by a linear-chain conditional random field, and scores of whole documents from its marginals.

Tokens are the maximal runs of letters (A-Z lower-cased, likewise the accented letters of Latin-1); a
token's features are itself, its beginnings and its endings, hashed into one table of weights.

*Labelled tokens.* Labels stand on documents. Features whose share of the toxic documents is `LIFT` times
their share of the clean ones are able to mark tokens; a greedy cover of the toxic documents picks those that
do. Their tokens are label 1; all others, and all tokens of clean documents, are label 0.

*Fit.* On a bounded sample of the labelled documents: weights and transitions by AdaGrad on the penalised
likelihood of the token labels, gradients from forward-backward. A logistic regression of the document's
label on the largest log-odds of a token and on log(1 + expected toxic tokens) then scales document scores.

*Scores.* Every document whole: marginals of its tokens, runs of tokens at 0.5 or more as spans.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapcredit.llm.chain import CLIP, marginals
from snapcredit.llm.common import map_arrow, text_chunks
from snapcredit.llm.rolling import BYTE_CODES, PrefixHash
from snapcredit.llm.word_runs import LOWER, byte_set, runs, with_breaks

CHUNK = 1 << 20
#: The table of weights has 2 ** BITS entries, 4 MB, whatever the corpus.
BITS = 20
#: Bytes of the beginnings and endings that are features.
HEADS, TAILS = (3, 4, 5, 6, 7), (3, 4, 5)
LETTER = byte_set((0x61, 0x7A), (0x80, 0xFF))
#: Sample for the fit: bytes of text and documents of each label, about; texts over LONGEST bytes are not in it.
SAMPLE_BYTES, SAMPLE_DOCS, LONGEST = 4_000_000, 20_000, 200_000
#: Lift of a telling feature; least gain of one, as a share of the toxic documents.
LIFT, LEAST_GAIN = 20.0, 0.002
ROUNDS, RATE, PENALTY, DAMPING = 25, 0.4, 0.02, 0.02


def tokens(raw: np.ndarray, lengths: np.ndarray):
    """Start and size, in the texts laid end to end, of each token, its text, and the lower-cased bytes with breaks."""
    raw, ends = with_breaks(raw, lengths, 0x20)
    raw = LOWER[raw]
    accented = np.flatnonzero((raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] <= 0x9E) & (raw[1:] != 0x97)) + 1
    raw[accented] += 0x20
    at, size = runs(LETTER[raw])
    return raw, at, size, np.searchsorted(ends, at, "right")


def token_features(raw: np.ndarray, at: np.ndarray, size: np.ndarray):
    """Table entries of one feature of every token after another."""
    parts = PrefixHash(BYTE_CODES[raw])
    shift = np.uint64(64 - BITS)
    yield (parts.of(at, size) >> shift).astype(np.int32)
    for k in HEADS:
        yield (parts.of(at, np.minimum(size, k)) * np.uint64(2 * k + 1) >> shift).astype(np.int32)
    for k in TAILS:
        n = np.minimum(size, k)
        yield (parts.of(at + size - n, n) * np.uint64(2 * k + 101) >> shift).astype(np.int32)


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float
    start: float
    trans: np.ndarray
    #: Weights of 1, the largest log-odds and the log of the expected toxic tokens.
    scale: np.ndarray


def log_odds(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-9, 1 - 1e-9)
    return np.log(p) - np.log1p(-p)


def document_measures(p: np.ndarray, owner: np.ndarray, n_docs: int) -> np.ndarray:
    """For each document 1, the largest log-odds of a token (none: the least) and log(1 + sum of the marginals)."""
    most = np.full(n_docs, log_odds(np.zeros(1))[0])
    np.maximum.at(most, owner, log_odds(p))
    return np.stack([np.ones(n_docs), most, np.log1p(np.bincount(owner, p, n_docs))], axis=1)


def document_counts(features: list[np.ndarray], owner: np.ndarray, toxic: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Toxic and clean documents with each table entry."""
    bad, good = np.zeros(1 << BITS, np.int64), np.zeros(1 << BITS, np.int64)
    for entry in features:
        key = np.unique(owner.astype(np.int64) << BITS | entry)
        hit = toxic[key >> BITS]
        entries = key & (1 << BITS) - 1
        bad += np.bincount(entries[hit], minlength=1 << BITS)
        good += np.bincount(entries[~hit], minlength=1 << BITS)
    return bad, good


def token_labels(features: list[np.ndarray], owner: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Which tokens stand for the label of their document.

    Of the features with enough lift, those that explain the toxic documents are picked greedily: a feature
    gains 1 / (1 + c) ** 2 for a document with c words picked before, so what only occurs next to telling
    words, as in copies of one document, gains next to nothing.
    """
    bad, good = document_counts(features, owner, toxic)
    lift = np.log((bad + 1) / (toxic.sum() + 2)) - np.log((good + 1) / (len(toxic) - toxic.sum() + 2))
    able = (lift >= np.log(LIFT)) & (bad > 1)
    if not able.any():
        able = (lift >= lift.max()) & (bad > 0)
    # A word of a document is one thing to be picked; by_entry holds the words of each able feature.
    word = owner.astype(np.int64) << BITS | features[0]
    found = [(entry[hit], word[hit]) for entry in features for hit in [np.flatnonzero(able[entry] & toxic[owner])]]
    entry, held = np.concatenate([e for e, _ in found]).astype(np.int64), np.concatenate([w for _, w in found])
    order = np.lexsort((held, entry))
    entry, held = entry[order], held[order]
    words, number = np.unique(held, return_inverse=True)
    cut = np.flatnonzero(np.concatenate([[True], entry[1:] != entry[:-1], [True]]))
    by_entry = [np.unique(number[a:b]) for a, b in zip(cut[:-1], cut[1:], strict=True)]
    doc = words >> BITS
    picked, depth = np.zeros(len(words), bool), np.zeros(len(toxic))

    def gain(k: int) -> float:
        return float(np.sum(1 / (1 + depth[np.unique(doc[(x := by_entry[k])[~picked[x]]])]) ** 2))

    least = max(1.0, LEAST_GAIN * toxic.sum())
    heap = [(-gain(k), k) for k in range(len(by_entry))]
    heapq.heapify(heap)
    while heap and -heap[0][0] >= least:
        _, k = heapq.heappop(heap)
        now = gain(k)  # gains only fall, so a feature that still leads is the best of all
        if heap and now < -heap[0][0]:
            heapq.heappush(heap, (-now, k))
            continue
        if now < least:
            break
        fresh = by_entry[k][~picked[by_entry[k]]]
        picked[fresh] = True
        depth += np.bincount(doc[fresh], minlength=len(toxic))
    return np.isin(word, words[picked])


def fit(texts: list[bytes], toxic: np.ndarray, share: np.ndarray) -> Model:
    """Model of labelled texts; share: how many documents of the whole set each stands for."""
    lengths = np.array([len(t) for t in texts], np.int64)
    raw, at, size, owner = tokens(np.frombuffer(b"".join(texts), np.uint8), lengths)
    features = list(token_features(raw, at, size))
    y = token_labels(features, owner, toxic).astype(float)
    first = np.concatenate([[True], owner[1:] != owner[:-1]])[: len(owner)]
    inner = np.flatnonzero(~first)
    pairs = np.zeros((2, 2))
    np.add.at(pairs, (y[inner - 1].astype(int), y[inner].astype(int)), 1.0)

    weights, small = np.zeros(1 << BITS, np.float32), np.array([-4.0, -4.0, 0.0, 0.0, 0.0, 0.0])
    # Damped, so that features of few tokens move in proportion and the common ones carry the decision.
    damp = (1 + DAMPING * y.sum()) ** 2
    seen, seen_small = np.full(1 << BITS, damp, np.float32), np.full(6, 1e-6)
    for _ in range(ROUNDS):
        e = small[0] + sum(weights[f] for f in features).astype(float)
        p, expected = marginals(e, first, small[1], small[2:].reshape(2, 2))
        gap = y - p
        slope = sum(np.bincount(f, gap, 1 << BITS) for f in features).astype(np.float32) - PENALTY * weights
        seen += slope * slope
        weights += RATE * slope / np.sqrt(seen)
        slope = np.concatenate([[gap.sum(), gap[first].sum()], (pairs - expected).ravel()]) - PENALTY * small
        seen_small += slope * slope
        small = small + RATE * slope / np.sqrt(seen_small)
    e = small[0] + sum(weights[f] for f in features).astype(float)
    p, _ = marginals(e, first, small[1], small[2:].reshape(2, 2))
    x = document_measures(p, owner, len(texts))
    return Model(weights, small[0], small[1], small[2:].reshape(2, 2), logistic(x, toxic.astype(float), share))


def logistic(x: np.ndarray, y: np.ndarray, share: np.ndarray, penalty: float = 0.01) -> np.ndarray:
    """Weights of a logistic regression with a quadratic penalty, by Newton steps."""
    beta = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -CLIP, CLIP)))
        slope = x.T @ (share * (y - p)) - penalty * beta
        curve = (x * (share * p * (1 - p))[:, None]).T @ x + (penalty + 1e-6) * np.eye(x.shape[1])
        step = np.linalg.solve(curve, slope)
        beta = beta + step * min(1.0, 2.0 / max(np.abs(step).max(), 1e-12))
    return beta


def tagged(model: Model, raw: np.ndarray, lengths: np.ndarray):
    """Score of each text, and start, end (bytes of the texts laid end to end) and text of each toxic span."""
    lowered, at, size, owner = tokens(raw, lengths)
    e = np.full(len(at), model.bias)
    for entry in token_features(lowered, at, size):
        e += model.weights[entry]
    first = np.concatenate([[True], owner[1:] != owner[:-1]])[: len(owner)]
    p, _ = marginals(e, first, model.start, model.trans)
    logit = document_measures(p, owner, len(lengths)) @ model.scale
    bad = p >= 0.5
    fresh = bad & (first | ~np.concatenate([[False], bad[:-1]]))
    final = bad & np.concatenate([first[1:] | ~bad[1:], [True]])[: len(bad)]
    # The bytes had one break after each text.
    start = at[fresh] - owner[fresh]
    end = (at + size)[final] - owner[final]
    return 1 / (1 + np.exp(-np.clip(logit, -CLIP, CLIP))), start, end, owner[fresh]


def is_held_out(doc_id: Column, folds: int = 3, fold: int = 1) -> Column:
    """Whether crc32 of the doc_id as text, modulo `folds`, is `fold`; a null doc_id is an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == fold


def training_sample(texts: DataFrame, labels: DataFrame, sample_bytes: int, longest: int) -> tuple:
    """Texts, labels and weights of the fit. Documents labelled both ways are left out.

    Ids and sizes meet the labels; about `sample_bytes` of text and SAMPLE_DOCS ids of each label are drawn by a
    hash of the id. Only the drawn ids, bounded so, are sent to the texts."""
    marks = labels.groupBy("doc_id").agg(F.min("toxic").alias("low"), F.max("toxic").alias("toxic"))
    marks = marks.where("low = toxic and toxic in (0, 1)").drop("low")
    able = texts.where(~is_held_out(F.col("doc_id"))).withColumn("size", F.octet_length("text"))
    able = able.where(F.col("size") <= longest)
    known = able.select("doc_id", "size").join(marks, "doc_id")
    totals = known.groupBy("toxic").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")).collect()
    shares = {r["toxic"]: min(1.0, sample_bytes / max(r["bytes"], 1), SAMPLE_DOCS / r["n"]) for r in totals}
    draw = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(11)), F.lit(1 << 30)) / (1 << 30)
    limit = F.when(F.col("toxic") == 1, shares.get(1, 1.0)).otherwise(shares.get(0, 1.0))
    drawn = known.where(draw < limit).select("doc_id", "toxic").distinct()
    rows = able.join(F.broadcast(drawn), "doc_id").select("doc_id", "text", "toxic").toPandas()
    rows = rows.sort_values(["doc_id", "text"])
    toxic = rows["toxic"].to_numpy(dtype=np.int64) == 1
    share = np.array([1 / shares[int(t)] for t in toxic])
    return [t.encode() for t in rows["text"]], toxic, share


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label_id: str = "doc_id",
    label: str = "toxic",
    threshold: float = 0.7,
    sample_bytes: int = SAMPLE_BYTES,
    longest: int = LONGEST,
) -> DataFrame:
    """Toxicity of every document, from a model of those labelled rows whose fold is not held out.

    Returns a row per row of `docs`: doc_id, held_out (crc32 of doc_id mod 3 is 1), score (0 to 1), predicted
    (1 from `threshold` on) and spans, the toxic stretches as structs of start and end in code points, end
    exclusive. Nothing but the text is an input of the score: equal texts have equal scores. A null text is
    empty; texts without letters get the score of no toxic token at all. Repeated rows are scored each; other
    columns play no part, whatever their names. A document labelled both ways, with another value than 0 and
    1, or null, is no training row; without training rows of both labels every score is the share of label 1
    (none: 0). The fit reads at most about `sample_bytes` of text and SAMPLE_DOCS documents of each label, of texts up
    to `longest` bytes; scores read every text whole. An empty `docs` gives no rows.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    texts = docs.select(F.col(doc_id).alias("doc_id"), body.alias("text"))
    known = labels.select(F.col(label_id).alias("doc_id"), F.col(label).cast("int").alias("toxic"))
    held, toxic, share = training_sample(texts, known, sample_bytes, longest)
    if toxic.any() and not toxic.all():
        model = fit(held, toxic, share)
    else:
        odds = CLIP if toxic.any() else -CLIP
        model = Model(np.zeros(1 << BITS, np.float32), -CLIP, 0.0, np.zeros((2, 2)), np.array([odds, 0.0, 0.0]))
    sent = docs.sparkSession.sparkContext.broadcast(model)
    spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def score(batches):
        for batch, raw, lengths in text_chunks(batches, limit=CHUNK):
            scores, start, end, owner = tagged(sent.value, raw, lengths)
            # Code points before each byte of the chunk, and before each text.
            points = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
            before = points[np.cumsum(lengths) - lengths][owner]
            places = pa.StructArray.from_arrays(
                [pa.array(points[start] - before), pa.array(points[end] - before)], ["start", "end"]
            )
            offsets = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(lengths)))])
            spans = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), places).cast(spans_type)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores), spans], ["doc_id", "score", "spans"])

    kind = texts.schema["doc_id"].dataType.simpleString()
    scored = map_arrow(texts, score, f"doc_id {kind}, score double, spans array<struct<start: bigint, end: bigint>>")
    return scored.select(
        "doc_id",
        is_held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
        "spans",
    )
