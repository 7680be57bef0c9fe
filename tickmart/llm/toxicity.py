"""Toxicity scores by a bidirectional gated recurrent network with attention pooling, trained here in numpy.

A word enters with an embedding of its own, with a convolution over the sequence of its letters, and with the evidence
that the training rows give the word and its most telling letter group. Windows of words overlap by half and cover the whole text; a document's
score is that of its most toxic window.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickmart.llm.text_arrays import column_buffer, slices, word_bounds, word_hashes

WINDOW, STRIDE = 32, 16
WORD_DIM, CHAR_DIM, HIDDEN, ATTEND = 7, 8, 8, 8
#: Letter groups and the convolution's filters are five bytes long, the one before the word's first counting as a mark;
#: for evidence, groups are hashed to so many places.
GROUP, GROUPS = 5, 1 << 17
#: Marks before a word's first byte and behind its last.
BEGIN, END = 1, 2
#: Places of the letter sequences that are convolved in one step.
LETTER_STEP = 1 << 18
#: Training rows fall into so many parts; evidence on a row comes from the other parts. Scoring has the evidence of all
#: rows, so the more parts, the closer training comes to it.
PARTS = 16
#: The weights are averaged over this last share of the steps.
AVERAGED = 0.4
#: At most so many labelled rows, of texts up to so many characters, are used for training.
SAMPLE_ROWS, SAMPLE_CHARS = 4000, 20_000
#: Words in fewer training documents have no embedding of their own.
LEAST_DOCUMENTS = 3
FOLDS = 5

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True


def fold(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo the number of folds; fold 0 is held out. A null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % FOLDS


# --- words ------------------------------------------------------------------------------------

def plain_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-case bytes, word starts and ends without punctuation at the edges, first word of each row."""
    low = _LOWER[data]
    starts, ends, first = word_bounds(low, offsets)
    for _ in range(3):
        starts = starts + (_PUNCTUATION[low[starts]] & (ends - starts > 1))
        ends = ends - (_PUNCTUATION[low[ends - 1]] & (ends - starts > 1))
    return low, starts, ends, first


def letter_groups(low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed letter group at every byte of the given words, and where each word's groups begin."""
    lengths = ends - starts
    heads = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum())) - np.repeat(heads, lengths)
    at = place + np.repeat(starts, lengths)
    size = np.repeat(lengths, lengths)
    out = np.zeros(len(at), np.int64)
    for k in range(-1, GROUP - 1):
        byte = low[np.clip(at + k, 0, max(len(low) - 1, 0))].astype(np.int64)
        out = out * 1000003 + np.where(place + k < 0, BEGIN, np.where(place + k >= size, END, byte))
    return (out ^ (out >> 23)) % GROUPS, heads


def letter_sequences(low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words' bytes with marks around each, and for every byte of a word the place where its filter begins."""
    lengths = ends - starts
    heads, nth = np.cumsum(lengths) - lengths, np.arange(len(lengths))
    at = np.arange(int(lengths.sum())) + np.repeat((GROUP - 1) * nth, lengths)
    letters = np.full(len(at) + (GROUP - 1) * len(lengths), END, np.uint8)
    letters[heads + (GROUP - 1) * nth] = BEGIN
    letters[at + 1] = low[np.arange(len(at)) + np.repeat(starts - heads, lengths)]
    return letters, at


def windows(first: np.ndarray, pad: int) -> tuple[np.ndarray, np.ndarray]:
    """Word positions of all windows of all rows (``pad`` behind a short row's end), and the row of each window."""
    counts = np.diff(first)
    number = np.where(counts <= WINDOW, 1, -(-(counts - WINDOW) // STRIDE) + 1)
    row = np.repeat(np.arange(len(counts)), number)
    nth = np.arange(int(number.sum())) - np.repeat(np.cumsum(number) - number, number)
    begin = np.minimum(nth * STRIDE, np.maximum(counts[row] - WINDOW, 0))
    at = begin[:, None] + np.arange(WINDOW)
    return np.where(at < counts[row][:, None], at + first[row][:, None], pad), row


# --- the network ------------------------------------------------------------------------------

def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def new_weights(vocabulary: int, seed: int) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    width = WORD_DIM + CHAR_DIM + 2
    scaled = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
    w = {"word": 0.1 * scaled(vocabulary + 1, WORD_DIM), "char": scaled(GROUP, 256, CHAR_DIM), "char_c": np.zeros(CHAR_DIM, np.float32)}
    w["word"][0] = 0
    for side in ("f", "b"):
        w |= {f"x{side}": scaled(width, 3 * HIDDEN), f"h{side}": scaled(HIDDEN, 3 * HIDDEN), f"c{side}": np.zeros(3 * HIDDEN, np.float32)}
    return w | {"att": scaled(2 * HIDDEN, ATTEND), "att_c": np.zeros(ATTEND, np.float32), "att_v": scaled(ATTEND, 1)[:, 0],
                "out": scaled(2 * HIDDEN, 1)[:, 0], "out_c": np.zeros(1, np.float32)}


def convolved(w: dict, letters: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Filter outputs at the given places; a filter has one weight for every byte at each of its positions."""
    return np.tanh(sum((w["char"][k][letters[at + k]] for k in range(GROUP)), w["char_c"]))


def letter_inputs(w: dict, letters: np.ndarray, at: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """Each filter's greatest output over a word, ``LETTER_STEP`` places at a time however long a word is."""
    out = np.full((len(heads), CHAR_DIM), -1, np.float32)
    for a in range(0, len(at), LETTER_STEP):
        b = min(a + LETTER_STEP, len(at))
        first, last = np.searchsorted(heads, [a, b - 1], side="right") - 1
        begin = np.maximum(heads[first:last + 1] - a, 0)
        here = np.maximum.reduceat(convolved(w, letters, at[a:b]), begin, axis=0)
        out[first:last + 1] = np.maximum(out[first:last + 1], here)
    return out


def letter_gradients(w: dict, letters: np.ndarray, at: np.ndarray, heads: np.ndarray, dinputs: np.ndarray) -> dict:
    """Gradients of the filters from those of ``letter_inputs``; places that tie for the greatest output share."""
    out = convolved(w, letters, at)
    word = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, len(at))))
    top = out == np.maximum.reduceat(out, heads, axis=0)[word]
    share = dinputs / np.add.reduceat(top, heads, axis=0, dtype=np.int64)
    place, dim = np.nonzero(top)
    part = share[word[place], dim] * (1 - out[place, dim]**2)
    filters = [np.bincount(letters[at[place] + k] * np.int64(CHAR_DIM) + dim, weights=part, minlength=256 * CHAR_DIM) for k in range(GROUP)]
    return {"char": np.reshape(filters, w["char"].shape), "char_c": np.bincount(dim, weights=part, minlength=CHAR_DIM)}


def word_inputs(w: dict, ids: np.ndarray, evidence: np.ndarray, group_evidence: np.ndarray, letters: np.ndarray, spots: np.ndarray,
                heads: np.ndarray) -> np.ndarray:
    """One input row per distinct word, and a row of zeros at the end for padding."""
    out = np.zeros((len(ids) + 1, WORD_DIM + CHAR_DIM + 2), np.float32)
    if len(ids):
        out[:-1, :WORD_DIM] = w["word"][ids]
        out[:-1, WORD_DIM:-2] = letter_inputs(w, letters, spots, heads)
        out[:-1, -2] = evidence
        out[:-1, -1] = group_evidence
    return out


def run_side(w: dict, side: str, projected: np.ndarray, at: np.ndarray, tape: list | None = None) -> np.ndarray:
    """States of one direction for windows ``at`` (rows of ``projected``), shape steps x windows x hidden."""
    steps = range(WINDOW) if side == "f" else range(WINDOW - 1, -1, -1)
    h, k = np.zeros((len(at), HIDDEN), np.float32), HIDDEN
    states = np.empty((WINDOW, len(at), HIDDEN), np.float32)
    for t in steps:
        x, g = projected[at[:, t]], h @ w[f"h{side}"]
        gates = sigmoid(x[:, :2 * k] + g[:, :2 * k])
        fresh = np.tanh(x[:, 2 * k:] + gates[:, k:] * g[:, 2 * k:])
        if tape is not None:
            tape.append((t, h, g, gates, fresh))
        h = fresh + gates[:, :k] * (h - fresh)
        states[t] = h
    return states


def pooled_logits(w: dict, states: np.ndarray) -> tuple[np.ndarray, tuple]:
    """Attention over the steps, then the output; also what the backward pass needs."""
    lifted = np.tanh(states @ w["att"] + w["att_c"])
    e = lifted @ w["att_v"]
    a = np.exp(e - e.max(axis=0))
    a /= a.sum(axis=0)
    pooled = np.einsum("tb,tbh->bh", a, states)
    return pooled @ w["out"] + w["out_c"][0], (lifted, a, pooled)


def logits(w: dict, inputs: np.ndarray, at: np.ndarray, batch: int = 2048) -> np.ndarray:
    """Logit of every window; the input projections are made once per distinct word."""
    forth, back = inputs @ w["xf"] + w["cf"], inputs @ w["xb"] + w["cb"]
    out = np.empty(len(at), np.float32)
    for i in range(0, len(at), batch):
        part = at[i:i + batch]
        states = np.concatenate([run_side(w, "f", forth, part), run_side(w, "b", back, part)], axis=2)
        out[i:i + batch] = pooled_logits(w, states)[0]
    return out


def gradients(w: dict, inputs: np.ndarray, at: np.ndarray, target: np.ndarray) -> tuple[dict, np.ndarray]:
    """Mean cross-entropy gradients of the weights and of the input rows."""
    projected = {s: inputs @ w[f"x{s}"] + w[f"c{s}"] for s in "fb"}
    tapes: dict[str, list] = {"f": [], "b": []}
    states = np.concatenate([run_side(w, s, projected[s], at, tapes[s]) for s in "fb"], axis=2)
    z, (lifted, a, pooled) = pooled_logits(w, states)
    dz = (sigmoid(z) - target) / len(at)
    g = {"out": pooled.T @ dz, "out_c": np.array([dz.sum()], np.float32)}
    dpool = dz[:, None] * w["out"]
    da = np.einsum("bh,tbh->tb", dpool, states)
    de = a * (da - (a * da).sum(axis=0))
    g["att_v"] = np.einsum("tb,tbk->k", de, lifted)
    dlift = de[:, :, None] * w["att_v"] * (1 - lifted**2)
    g["att"] = np.einsum("tbh,tbk->hk", states, dlift)
    g["att_c"] = dlift.sum(axis=(0, 1))
    dstates = a[:, :, None] * dpool + dlift @ w["att"].T
    dinputs = np.zeros_like(inputs)
    k = HIDDEN
    for s, part in (("f", slice(0, k)), ("b", slice(k, 2 * k))):
        dproj, dh, gh = np.zeros_like(projected[s]), np.zeros((len(at), k), np.float32), np.zeros_like(w[f"h{s}"])
        for t, h, lin, gates, fresh in reversed(tapes[s]):
            dh = dh + dstates[t][:, part]
            keep, reset = gates[:, :k], gates[:, k:]
            dfresh = dh * (1 - keep) * (1 - fresh**2)
            dgate = np.concatenate([dh * (h - fresh), dfresh * lin[:, 2 * k:]], axis=1) * gates * (1 - gates)
            dlin = np.concatenate([dgate, dfresh * reset], axis=1)
            np.add.at(dproj, at[:, t], np.concatenate([dgate, dfresh], axis=1))
            gh += h.T @ dlin
            dh = dh * keep + dlin @ w[f"h{s}"].T
        g |= {f"h{s}": gh, f"x{s}": inputs.T @ dproj, f"c{s}": dproj.sum(axis=0)}
        dinputs += dproj @ w[f"x{s}"].T
    return g, dinputs


# --- training ---------------------------------------------------------------------------------

def _evidence(toxic_docs: np.ndarray, docs: np.ndarray, rate: float) -> np.ndarray:
    """How far the toxic documents among ``docs`` exceed the expected number, on a logarithmic scale; never negative."""
    z = (toxic_docs - rate * docs) / np.sqrt(rate * (1 - rate) * np.maximum(docs, 1))
    return np.where(docs >= LEAST_DOCUMENTS - 1, np.log1p(np.maximum(z, 0)) / 2, 0).astype(np.float32)


def _counts(blocks: Iterable[tuple[np.ndarray, np.ndarray]], toxic: np.ndarray, part: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents with an item, all and toxic ones: totals first, then without each part.

    Blocks are (item, document) pairs; no document is in two blocks.
    """
    docs, found = np.zeros(PARTS * n, np.int64), np.zeros(PARTS * n)
    for item, owner in blocks:
        pairs = np.unique(owner * np.int64(n) + item)
        item, owner = pairs % n, pairs // n
        at = part[owner] * np.int64(n) + item
        docs += np.bincount(at, minlength=PARTS * n)
        found += np.bincount(at, weights=toxic[owner], minlength=PARTS * n)
    docs, found = docs.reshape(PARTS, n), found.reshape(PARTS, n)
    return (np.concatenate([docs.sum(axis=0)[None], docs.sum(axis=0) - docs]),
            np.concatenate([found.sum(axis=0)[None], found.sum(axis=0) - found]))


def _group_blocks(word: np.ndarray, owner: np.ndarray, groups: np.ndarray, heads: np.ndarray, size: np.ndarray
                  ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Letter groups of (word, document) pairs, some hundred documents at a time; documents ascend."""
    for first in range(0, int(owner[-1]) + 1 if len(owner) else 0, 256):
        a, b = np.searchsorted(owner, [first, first + 256])
        w = word[a:b]
        place = np.arange(int(size[w].sum())) - np.repeat(np.cumsum(size[w]) - size[w], size[w])
        yield groups[np.repeat(heads[w], size[w]) + place], np.repeat(owner[a:b], size[w])


def train(texts: pa.Array, toxic: np.ndarray, seed: int = 8, steps: int = 480, batch: int = 128, rounds: int = 4) -> dict:
    """Fit the network to whole texts and their labels.

    A toxic document need not be toxic everywhere: each round learns from the windows of toxic documents that look
    worst so far (by evidence at first, then by the network) and from the worst and random windows of the others.
    Evidence on a row never includes the row itself, so that rare words mislead here as little as in new texts.
    The weights kept are the average over the last steps, which vary less with the seed and the order of the rows.
    The output is shifted so that 0 is the logit that separates the training documents best.
    """
    rng = np.random.default_rng(seed)
    data, offsets = column_buffer(texts)
    low, starts, ends, first = plain_words(data, offsets)
    hashes = word_hashes(low, starts, ends)
    rate = float(toxic.mean()) if len(toxic) else 0.0
    model = {"rate": (float(toxic.sum()) + 0.5) / (len(toxic) + 1.0), "known": np.zeros(0, np.uint64)}
    if not 0 < rate < 1 or not len(hashes):
        return model
    distinct, where, inverse = np.unique(hashes, return_index=True, return_inverse=True)
    row = np.repeat(np.arange(len(texts)), np.diff(first))
    part = rng.permutation(len(texts)) % PARTS
    n = len(distinct)
    docs, found = _counts([(inverse, row)], toxic, part, n)
    own = docs[0] >= LEAST_DOCUMENTS
    ids = np.where(own, np.cumsum(own), 0)
    evidence = np.where(own, _evidence(found, docs, rate), 0)
    groups, heads = letter_groups(low, starts[where], ends[where])
    letters, spots = letter_sequences(low, starts[where], ends[where])
    size = np.diff(np.append(heads, len(groups)))
    pairs = np.unique(row * np.int64(n) + inverse)
    word, owner = pairs % n, pairs // n
    group_docs, group_found = _counts(_group_blocks(word, owner, groups, heads, size), toxic, part, GROUPS)
    group_table = _evidence(group_found, group_docs, rate)
    group_evidence = np.stack([np.maximum.reduceat(table[groups], heads) for table in group_table])
    w = new_weights(int(own.sum()), seed)
    at, owner_of = windows(first, -1)
    at = np.where(at < 0, n, np.append(inverse, n)[at])
    label, side = toxic[owner_of], part[owner_of] + 1

    def rated() -> np.ndarray:
        out = np.empty(len(at), np.float32)
        inputs = word_inputs(w, ids, evidence[0], group_evidence[0], letters, spots, heads)
        for k in range(1, PARTS + 1):
            mine = side == k
            inputs[:-1, -2], inputs[:-1, -1] = evidence[k], group_evidence[k]
            out[mine] = logits(w, inputs, at[mine])
        return out

    both = np.concatenate([evidence + group_evidence, np.zeros((PARTS + 1, 1), np.float32)], axis=1)
    rating = np.empty(len(at), np.float32)
    for k in range(1, PARTS + 1):
        rating[side == k] = both[k][at[side == k]].max(axis=1)
    moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in w.items()}
    step, last = 0, steps // rounds * rounds
    averaged = max(int(AVERAGED * last), 1)
    mean = {k: np.zeros(v.shape) for k, v in w.items()}
    for nth_round in range(rounds):
        if nth_round:
            rating = rated()
        order = np.lexsort((-rating, owner_of))
        nth = np.arange(len(order)) - np.searchsorted(owner_of[order], owner_of[order])
        worst = order[nth < 2]
        bad, clean = worst[(label[worst] == 1) & (nth[nth < 2] == 0)], np.flatnonzero(label == 0)
        good = np.concatenate([worst[label[worst] == 0], clean[rng.integers(0, len(clean), len(worst))]])
        for _ in range(steps // rounds):
            pick = np.concatenate([rng.choice(bad, batch // 2), rng.choice(good, batch - batch // 2)])
            used, local = np.unique(np.where(at[pick] < n, at[pick] + side[pick][:, None] * n, (PARTS + 1) * n), return_inverse=True)
            used = used[used < (PARTS + 1) * n]
            local = local.reshape(len(pick), WINDOW)
            k, u = used // n, used % n
            begin = np.cumsum(size[u]) - size[u]
            flat = spots[np.arange(int(size[u].sum())) + np.repeat(heads[u] - begin, size[u])]
            shown = np.where(rng.random(len(u)) < 0.5, ids[u], 0)
            inputs = word_inputs(w, shown, evidence[k, u], group_evidence[k, u], letters, flat, begin)
            if local.max() < len(u):
                inputs = inputs[:-1]
            g, dinputs = gradients(w, inputs, local, label[pick].astype(np.float32))
            dinputs = dinputs[:len(u)]
            g |= letter_gradients(w, letters, flat, begin, dinputs[:, WORD_DIM:-2])
            g["word"] = np.zeros_like(w["word"])
            np.add.at(g["word"], shown, dinputs[:, :WORD_DIM])
            g["word"][0] = 0
            step += 1
            for key, v in w.items():
                m, s = moment[key]
                grad = (g[key] + 1e-4 * v).astype(np.float32)
                m += 0.1 * (grad - m)
                s += 0.001 * (grad**2 - s)
                v -= (0.01 * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
                if step > last - averaged:
                    mean[key] += (v - mean[key]) / (step - last + averaged)
    w = {k: v.astype(np.float32) for k, v in mean.items()}
    rating = rated()
    tops = np.full(len(texts), -np.inf)
    np.maximum.at(tops, owner_of, rating)
    w["out_c"] = w["out_c"] - np.float32(best_cut(tops, toxic))
    return model | {"known": distinct[own], "evidence": evidence[0][own], "groups": group_table[0], "weights": w}


def best_cut(tops: np.ndarray, toxic: np.ndarray) -> float:
    """The logit that separates the labels with the fewest errors, in the middle of its gap."""
    order = np.argsort(tops)
    t, y = tops[order], toxic[order]
    errors = np.concatenate([[0], np.cumsum(y)]) + np.concatenate([np.cumsum((1 - y)[::-1])[::-1], [0]])
    best = np.flatnonzero(errors == errors.min())
    cut = int(best[len(best) // 2])
    lower, upper = t[max(cut - 1, 0)], t[min(cut, len(t) - 1)]
    return float(lower + upper) / 2


# --- scoring ----------------------------------------------------------------------------------

def text_scores(model: dict, column: pa.Array) -> np.ndarray:
    """Score of every text: all its windows, the most toxic one counts."""
    out = np.full(len(column), model["rate"])
    if "weights" not in model:
        return out
    w, known = model["weights"], model["known"]
    data, offsets = column_buffer(column)
    for a, b in slices(offsets, 1 << 20):
        low, starts, ends, first = plain_words(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
        distinct, where, inverse = np.unique(word_hashes(low, starts, ends), return_index=True, return_inverse=True)
        slot = np.minimum(np.searchsorted(known, distinct), max(len(known) - 1, 0))
        hit = known[slot] == distinct if len(known) else np.zeros(len(distinct), bool)
        ids = np.where(hit, slot + 1, 0)
        evidence = np.where(hit, model["evidence"][slot], 0) if len(known) else np.zeros(len(distinct), np.float32)
        groups, heads = letter_groups(low, starts[where], ends[where])
        told = np.maximum.reduceat(model["groups"][groups], heads) if len(groups) else np.zeros(0, np.float32)
        inputs = word_inputs(w, ids, evidence, told, *letter_sequences(low, starts[where], ends[where]), heads)
        spot = np.append(inverse, len(distinct))
        tops = np.full(b - a, -np.inf)
        for rows in _row_ranges(first):
            at, owner = windows(first[rows[0]:rows[1] + 1], -1)
            z = logits(w, inputs, spot[at])
            np.maximum.at(tops[rows[0]:rows[1]], owner, z)
        out[a:b] = sigmoid(tops)
    return out


def _row_ranges(first: np.ndarray, words: int = 1 << 18) -> Iterator[tuple[int, int]]:
    yield from slices(first, words)


def training_rows(docs: DataFrame, labels: DataFrame, sample_rows: int, sample_chars: int) -> DataFrame:
    """``(text, toxic)`` of at most ``sample_rows`` labelled documents outside fold 0, chosen by a hash of the id."""
    known = (labels.where(fold() != 0).where("toxic IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id")
             .agg(F.max("toxic").alias("toxic")))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    return (docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
            .where(F.length("text") <= sample_chars).orderBy(F.xxhash64("doc_id"), "text").limit(sample_rows).select("text", "toxic"))


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, sample_chars: int = SAMPLE_CHARS, **settings) -> dict:
    """A model from labelled documents outside fold 0; without both labels it is the base rate.

    The bounded sample is trained on in one task, which a lost executor only repeats; the driver gets the model.
    """
    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = list(batches)
        if parts:
            rows = pa.Table.from_batches(parts)
            text = pa.concat_arrays([c.cast(pa.large_string()) for c in rows.column("text").chunks])
            model = train(text, rows.column("toxic").to_numpy().astype(np.float64), **settings)
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])

    made = training_rows(docs, labels, sample_rows, sample_chars).repartition(1).mapInArrow(fitted, "model binary").first()
    return pickle.loads(made["model"]) if made else train(pa.array([], pa.string()), np.zeros(0))


def scored(docs: DataFrame, model: dict) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` of every row.

    ``score`` runs from 0 to 1, ``predicted`` is 1 from 0.5 up. All words of a text are read. Null, empty and blank
    texts get the score of a window of padding. Equal texts score alike; repeated rows are scored one by one. A null
    doc_id counts as held out. Other columns are ignored, and none but the text is an input. An empty table gives an
    empty result. The model is broadcast; training bounds its size to some megabytes.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = text_scores(shared.value, batch.column(1)) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(score, pa.float64()),
                                              pa.array((score >= 0.5).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    return docs.select("doc_id", "text", (fold() == 0).alias("held_out")).mapInArrow(
        rows, f"doc_id {kind}, held_out boolean, score double, predicted int")


def without_toxic(docs: DataFrame, model: dict) -> DataFrame:
    """The rows whose score is below 0.5, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield batch.filter(pa.array(text_scores(shared.value, batch.column(names.index("text"))) < 0.5))

    names = docs.columns
    return docs.mapInArrow(rows, docs.schema)
