"""Quality classifier: a byte-level convolutional network in numpy.

A document is cut into overlapping chunks that cover all its bytes. Learned filters, WIDTH bytes
wide and STRIDE apart, run over each chunk; the maximum of each filter is taken in each chunk,
the chunks' maxima are averaged over the document and combined into one probability.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmere.llm.common import arrow_map, bounded_sample, keep, text_bytes

CHUNK, OVERLAP, WIDTH, STRIDE, FILTERS = 512, 64, 8, 2, 24
#: The network is fitted on at most so many labelled documents, on all chunks of each; chunks that pass through the filters at a time.
MAX_LABELLED, PASS = 4000, 256
PAD = 32


def chunk_starts(length: int) -> np.ndarray:
    """First bytes of the chunks of a document; the last chunk holds its end."""
    return np.arange(0, max(1, length - OVERLAP), CHUNK - OVERLAP)


def chunks(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Rows of CHUNK bytes from each start, spaces beyond each end."""
    at = starts[:, None] + np.arange(CHUNK)
    inside = at < ends[:, None]
    return np.where(inside, data[np.minimum(at, max(len(data) - 1, 0))], PAD) if len(data) else np.full(at.shape, PAD, np.uint8)


class Net:
    """table[w, byte, filter]; out: weights of the pooled filters; bias."""

    def __init__(self, table: np.ndarray, shift: np.ndarray, out: np.ndarray, bias: float):
        self.table, self.shift, self.out, self.bias = table, shift, out, bias

    def response(self, c: np.ndarray) -> np.ndarray:
        """Filter responses (chunk, place, filter)."""
        n = (CHUNK - WIDTH) // STRIDE + 1
        r = None
        for w in range(WIDTH):
            part = self.table[w][c[:, w : w + STRIDE * (n - 1) + 1 : STRIDE]]
            r = part if r is None else np.add(r, part, out=r)
        return r

    def pooled(self, c: np.ndarray) -> np.ndarray:
        return np.maximum(self.response(c).max(1) + self.shift, 0)

    def probability(self, data: np.ndarray, offsets: np.ndarray, batch: int = 64) -> np.ndarray:
        """One probability for each document of a batch."""
        starts, ends, doc = [], [], []
        for d, (a, b) in enumerate(zip(offsets[:-1], offsets[1:])):
            s = chunk_starts(int(b - a)) + a
            starts.append(s), ends.append(np.full(len(s), b)), doc.append(np.full(len(s), d))
        n = len(offsets) - 1
        if n == 0:
            return np.zeros(0)
        starts, ends, doc = map(np.concatenate, (starts, ends, doc))
        total = np.zeros((n, len(self.out)))
        for i in range(0, len(starts), batch):
            np.add.at(total, doc[i : i + batch], self.pooled(chunks(data, starts[i : i + batch], ends[i : i + batch])))
        z = total / np.bincount(doc, minlength=n)[:, None] @ self.out + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_net(docs: list[np.ndarray], y: np.ndarray, epochs: int = 6, batch: int = 64, rate: float = 0.01, seed: int = 11) -> Net:
    """docs: for each document its chunks. Adam on the logistic loss; the gradient passes through each chunk's maxima.
    Without both classes the network says what there is."""
    rng = np.random.default_rng(seed)
    net = Net(rng.normal(0, 0.3, (WIDTH, 256, FILTERS)).astype(np.float32), np.zeros(FILTERS, np.float32), rng.normal(0, 0.1, FILTERS).astype(np.float32), 0.0)
    if not 0 < y.sum() < len(y):
        net.out[:] = 0
        net.bias = 4.0 if len(y) == 0 or y.all() else -4.0
        return net
    net.bias = float(np.log(y.mean() / (1 - y.mean())))
    par = {"table": net.table, "shift": net.shift, "out": net.out, "bias": np.array([net.bias], np.float32)}
    one, two = ({k: np.zeros_like(v) for k, v in par.items()} for _ in range(2))
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(docs))
        for i in range(0, len(order), batch):
            pick = order[i : i + batch]
            c = np.concatenate([docs[j] for j in pick])
            size = np.array([len(docs[j]) for j in pick])
            doc = np.repeat(np.arange(len(pick)), size)
            tops, best = [], []
            for at in range(0, len(c), PASS):
                r = net.response(c[at : at + PASS])
                tops.append(r.argmax(1))
                best.append(np.take_along_axis(r, tops[-1][:, None], 1)[:, 0])
            top, m = np.concatenate(tops), np.concatenate(best) + net.shift
            pool = np.zeros((len(pick), FILTERS), np.float32)
            np.add.at(pool, doc, np.maximum(m, 0))
            pool /= size[:, None]
            p = 1 / (1 + np.exp(-np.clip(pool @ net.out + par["bias"][0], -30, 30)))
            dz = (p - y[pick]).astype(np.float32) / len(pick)
            dm = (dz[:, None] * net.out)[doc] / size[doc][:, None] * (m > 0)
            grad = {"out": pool.T @ dz + 1e-4 * net.out, "bias": np.array([dz.sum()]), "shift": dm.sum(0), "table": np.zeros_like(net.table)}
            rows, f = np.arange(len(c))[:, None], np.arange(FILTERS)[None, :]
            for w in range(WIDTH):
                np.add.at(grad["table"][w], (c[rows, top * STRIDE + w], np.broadcast_to(f, top.shape)), dm)
            step += 1
            for k, v in par.items():
                one[k] += 0.1 * (grad[k] - one[k])
                two[k] += 0.01 * (grad[k] ** 2 - two[k])
                v -= rate * (one[k] / (1 - 0.9**step)) / (np.sqrt(two[k] / (1 - 0.99**step)) + 1e-7)
    net.bias = float(par["bias"][0])
    return net


def fit(docs: DataFrame, labels: DataFrame, trainable, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", bound: int = MAX_LABELLED) -> Net:
    """A network for P(label = 1) from at most bound labelled rows where the condition `trainable` (on doc_id) holds."""
    own = keep(labels, doc_id="doc_id", label=label_col).where(trainable & F.expr("doc_id is not null and label in (0, 1)")).groupBy("doc_id").agg(F.max("label").cast("int").alias("label"))
    some = keep(docs, doc_id=id_col, text=text_col).join(F.broadcast(bounded_sample(own, "doc_id", bound)), "doc_id")

    # bounded again, by rows: a table may repeat an id
    got = sorted(bounded_sample(some.select("doc_id", "label", "text"), "doc_id", bound).collect(), key=lambda r: (r.doc_id, r.label, r.text or ""))
    texts = [np.frombuffer((r.text or "").encode(), np.uint8) for r in got]
    cut = lambda t: chunks(t, (s := chunk_starts(len(t))), np.full(len(s), len(t)))
    return fit_net([cut(t) for t in texts], np.array([r.label for r in got], float))


def score(docs: DataFrame, net: Net, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score (0 to 1), predicted (1 if score >= 0.5) of each row of docs.

    Null and empty texts are scored as a chunk of spaces; without labels of both kinds every text gets the same score.
    Null ids stay; repeated rows give a row each; other columns, labels, lang and source among them, aren't read.
    """

    def run(b: pa.RecordBatch) -> dict:
        p = net.probability(*text_bytes(b.column("text")))
        return {"doc_id": b.column("doc_id"), "score": pa.array(p), "predicted": pa.array((p >= 0.5).astype(np.int32))}

    return arrow_map(keep(docs, doc_id=id_col, text=text_col), run, "doc_id long, score double, predicted int")
