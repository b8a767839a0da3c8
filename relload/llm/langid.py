"""Language identification by nearest centroid.

A text is a vector of hashed letter n-grams (pairs and triples, words bounded by one
space), weighted by log term frequency and inverse document frequency and normalised.
Each language has several centroids, clustered from all of its distinct labelled texts
in passes that add up vectors where they lie; a text gets the language of the centroid
with the largest cosine.  Texts whose best cosine lies under a distance threshold learned
from all labelled texts are rejected; the
threshold falls with the square root of the distinct n-grams, since few n-grams cannot
lie close to any centroid.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relload.llm.common import map_texts, write_table

BUCKETS = 4096
MAX_LANGS = 1000  # languages learned, the most frequent first, at most
MAX_SAMPLE = 4000  # centroids of all languages together, at most: one vector each is held
CENTROIDS = 4
ROUNDS = 6  # passes that move the centroids, at most
ONE = 1 << 30  # vectors add up as integers: sums do not depend on how the rows are dealt out
FAR = 5.0  # so many times less similar than all but 0.5 % of the labelled texts is too far
FULL_GRAMS = 500  # distinct n-grams from which on the cosine no longer grows with the text
UNKNOWN = "und"


@dataclass
class Model:
    """Inverse document frequencies, unit centroids with their languages, and the cosine under which a full text is rejected."""

    idf: object
    centroids: object
    langs: list
    threshold: float


@lru_cache(maxsize=1)
def _letters():
    import numpy as np

    return np.fromiter((chr(i).isalpha() for i in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


def letter_grams(text: bytes):
    """Counts of the text's n-grams by bucket; None if it has no letter."""
    import numpy as np

    code = np.frombuffer(text.decode("utf-8", "replace").lower().encode("utf-32-le", "replace"), np.uint32)
    letter = _letters()[code]
    if not letter.any():
        return None
    code = np.where(letter, code, 32)
    code = np.concatenate(([32], code[letter | np.concatenate(([True], letter[:-1]))], [32])).astype(np.uint32)
    pair = code[:-1] * np.uint32(0x9E3779B1) + code[1:] * np.uint32(0x85EBCA6B)
    triple = pair[:-1] * np.uint32(0xC2B2AE35) + code[2:] * np.uint32(0x27D4EB2F)
    both = np.concatenate((pair ^ (pair >> np.uint32(15)), triple ^ (triple >> np.uint32(13))))
    return np.bincount((both * np.uint32(0x165667B1)) >> np.uint32(20), minlength=BUCKETS)


def _unit(counts, idf):
    import numpy as np

    v = np.log1p(counts) * idf
    return v / max(float(np.linalg.norm(v)), 1e-12)


def _reach(distinct):
    """How much of a full text's cosine one with so many distinct n-grams can have."""
    import numpy as np

    return np.sqrt(np.clip(np.asarray(distinct, float) / FULL_GRAMS, 1e-9, 1.0))


def fit(docs: DataFrame, learn: Column, lang_col: str = "lang", text_col: str = "text", seed: int = 11) -> Model:
    """Learn from the rows of ``docs`` where ``learn`` holds and text and language are not null.

    Document frequencies count all of those rows, and centroids and the threshold come from
    all of their distinct texts: copies do not count.  The n-grams are counted once and
    kept as a narrow table that every pass reads.  A language starts with the mean of its
    texts and gains centroids at the mean of those that are less near than the average.
    Centroids nearest to which most texts belong to another language are dropped.  With no
    labelled rows the model knows no language.
    """
    import numpy as np

    rows = docs.where(learn).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where("lang is not null and text is not null")
    grams = _grams(rows)
    counted = grams.mapInArrow(_document_counts, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    df = {r["bucket"]: r["n"] for r in counted.collect()}  # one row a bucket
    total = df.pop(-1, 0)
    idf = np.zeros(BUCKETS)
    for bucket, n in df.items():
        idf[bucket] = np.log((1 + total) / n)

    known = grams.groupBy("lang").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "lang").limit(MAX_LANGS)
    langs = sorted(r["lang"] for r in known.collect())
    if not langs:
        return Model(idf, np.zeros((0, BUCKETS)), [], 0.0)
    # each pass: per centroid the sum of its texts, how many, how many of its own language, and their nearness
    most = max(1, min(CENTROIDS, MAX_SAMPLE // len(langs)))
    own = {lang: np.zeros((0, BUCKETS)) for lang in langs}
    for lang, (vector, *_) in _pass(grams, idf, own, None).items():
        own[lang[0]] = _rows([vector])
    for _ in range(most - 1):
        near: dict = {}
        for (lang, _), (_, n, _, cosines) in _pass(grams, idf, own, None, sums=False).items():
            near.setdefault(lang, []).append((n, cosines))
        average = {lang: sum(c for _, c in x) / sum(n for n, _ in x) for lang, x in near.items()}
        for lang, (vector, *_) in _pass(grams, idf, own, average).items():
            own[lang[0]] = np.concatenate((own[lang[0]], _rows([vector])))
    before = None
    for _ in range(ROUNDS if most > 1 else 0):
        found = _pass(grams, idf, own, None)
        for lang in langs:
            own[lang] = _rows([found[lang, i][0] if (lang, i) in found else c for i, c in enumerate(own[lang])])
        sizes = {k: v[1] for k, v in found.items()}
        if before is not None and sum(abs(sizes.get(k, 0) - before.get(k, 0)) for k in sizes.keys() | before.keys()) <= 0.002 * sum(sizes.values()):
            break
        before = sizes
    for _ in range(most):  # drop mislabelled clusters, of each language the worst first
        found = _pass(grams, idf, own, None, across=True, sums=False)
        drop = {}
        for lang, c in own.items():
            pure = [found[lang, i][2] / found[lang, i][1] if (lang, i) in found else 0.0 for i in range(len(c))]
            if len(c) > 1 and min(pure) < 0.5:
                drop[lang] = int(np.argmin(pure))
        if not drop:
            break
        for lang, i in drop.items():
            own[lang] = np.delete(own[lang], i, 0)
    centre, name = np.concatenate([own[x] for x in langs]), [x for x in langs for _ in own[x]]
    return Model(idf, centre, name, _quantile(grams, idf, centre, 0.005) / FAR)


def _rows(vectors):
    """Vectors as rows of unit length."""
    import numpy as np

    v = np.array(vectors, float)
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)


def _grams(rows: DataFrame) -> DataFrame:
    """(lang, h, n, hit, count): the n-gram counts of every distinct text that has a letter, and how often the text is there."""
    import pyarrow as pa

    def counts(batches):
        import numpy as np

        for b in batches:
            out = []
            for lang, h, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).cast(pa.binary()).to_pylist()):
                c = letter_grams(t)
                if c is not None:
                    hit = np.flatnonzero(c)
                    out.append((lang, h, hit.astype(np.uint16).tobytes(), c[hit].astype(np.uint32).tobytes()))
            types = pa.string(), pa.int64(), pa.binary(), pa.binary()
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 4, types)], names=["lang", "h", "hit", "count"])

    found = map_texts(rows.select("lang", F.xxhash64("text"), "text"), counts, "lang string, h long, hit binary, count binary")
    of = F.struct("hit", "count")
    found = found.groupBy("lang", "h").agg(F.count("*").alias("n"), F.first(of).alias("of")).select("lang", "h", "n", "of.hit", "of.count")
    return write_table(found, "labelled-grams")


def _document_counts(batches):
    import numpy as np
    import pyarrow as pa

    df, total = np.zeros(BUCKETS, np.int64), 0
    for b in batches:
        for hit, n in zip(b.column(b.schema.get_field_index("hit")).to_pylist(), b.column(b.schema.get_field_index("n")).to_pylist()):
            df[np.frombuffer(hit, np.uint16)] += n
            total += n
    some = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(some, -1)), pa.array(np.append(df[some], total))], names=["bucket", "n"])


def _vectors(batches, idf):
    """(language, n-grams, their values) of the unit vector of each text of :func:`_grams`."""
    import numpy as np

    for b in batches:
        at = b.schema.get_field_index
        for lang, hit, count in zip(*(b.column(at(c)).to_pylist() for c in ("lang", "hit", "count"))):
            hit = np.frombuffer(hit, np.uint16)
            v = np.log1p(np.frombuffer(count, np.uint32)) * idf[hit]
            yield lang, hit, v / max(float(np.linalg.norm(v)), 1e-12)


def _pass(grams: DataFrame, idf, own: dict, under: dict | None, across: bool = False, sums: bool = True) -> dict:
    """{(language, centroid): (sum of vectors, texts, texts of that language, sum of cosines)} over all texts.

    A text counts for the nearest centroid of its language (of any, with ``across``); with
    ``under`` only texts less near than their language's number there count, for one new centroid.
    """
    import numpy as np
    import pyarrow as pa

    centre = np.concatenate(list(own.values()))
    name = [(x, i) for x, c in own.items() for i in range(len(c))]
    first = dict(zip(own, np.cumsum([0, *map(len, own.values())]).tolist()))
    schema = "lang string, i int, vector binary, n long, own long, cosines long"

    def run(batches):
        held: dict = {}
        for lang, hit, v in _vectors(batches, idf):
            if lang not in own:
                continue
            of = slice(None) if across else slice(first[lang], first[lang] + len(own[lang]))
            near = np.rint(centre[of, hit] @ v * ONE)  # on a grid, as the sums are
            best = int(near.argmax()) if len(near) else -1
            cosine = int(near[best]) if len(near) else 0
            if under is not None and cosine >= under[lang]:
                continue
            key = (lang, -1) if under is not None or best < 0 else name[best + (0 if across else first[lang])]
            if key not in held:
                held[key] = [np.zeros(BUCKETS if sums else 0, np.int64), 0, 0, 0]
            old = held[key]
            if sums:
                old[0][hit] += np.rint(v * ONE).astype(np.int64)
            old[1], old[2], old[3] = old[1] + 1, old[2] + (key[0] == lang), old[3] + cosine
        rows = [(lang, i, v.tobytes(), n, m, c) for (lang, i), (v, n, m, c) in held.items()]
        types = pa.string(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.int64()
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 6, types)], names=["lang", "i", "vector", "n", "own", "cosines"])

    def add(key, table):  # a row a task and centroid
        vector, n, m, c = 0, 0, 0, 0
        for v, *x in zip(*(table.column(f).to_pylist() for f in ("vector", "n", "own", "cosines"))):
            vector, n, m, c = vector + np.frombuffer(v, np.int64), n + x[0], m + x[1], c + x[2]
        values = key[0].as_py(), key[1].as_py(), vector.tobytes(), n, m, c
        return pa.table({f.name: pa.array([v], f.type) for f, v in zip(table.schema, values)})

    found = map_texts(grams, run, schema).groupBy("lang", "i").applyInArrow(add, schema)
    return {(r["lang"], r["i"]): (np.frombuffer(r["vector"], np.int64) / ONE, r["n"], r["own"], r["cosines"]) for r in found.collect()}  # one row a centroid


def _quantile(grams: DataFrame, idf, centre, share: float) -> float:
    """The ``share`` quantile, to 0.0001, of how near texts are to a centroid beside what their length allows."""
    import numpy as np
    import pyarrow as pa

    def run(batches):
        steps: dict = {}
        for _, hit, v in _vectors(batches, idf):
            near = float((centre[:, hit] @ v).max() / _reach((v > 0).sum()))
            step = min(max(int(near * 10_000), 0), 20_000)
            steps[step] = steps.get(step, 0) + 1
        yield pa.RecordBatch.from_arrays([pa.array(list(steps), pa.int64()), pa.array(list(steps.values()), pa.int64())], names=["step", "n"])

    steps = map_texts(grams, run, "step long, n long").groupBy("step").agg(F.sum("n").alias("n")).orderBy("step").collect()  # 20,001 at most
    upto = np.cumsum([r["n"] for r in steps])
    return steps[int(np.searchsorted(upto, share * upto[-1]))]["step"] / 10_000


def predict(docs: DataFrame, model: Model, text_col: str, lang_out: str, score_out: str, rejected_out: str) -> DataFrame:
    """``docs`` with the predicted language, its cosine (0 to 1) and whether the text is rejected.

    Null texts and texts without a letter are ``und`` with score 0 and rejected, as is
    every text of a model that knows no language.  Other texts always get a learned
    language; those under the threshold are marked rejected.  Whole texts count, however
    long; all columns of ``docs`` are kept.
    """
    import pyarrow as pa

    schema = T.StructType([*docs.schema.fields, T.StructField(lang_out, T.StringType()), T.StructField(score_out, T.DoubleType()), T.StructField(rejected_out, T.BooleanType())])
    place = docs.columns.index(text_col)

    def run(batches):
        import numpy as np

        for b in batches:
            lang, score, rejected = [], [], []
            for t in b.column(place).cast(pa.binary()).to_pylist():
                counts = letter_grams(t) if t and model.langs else None
                if counts is None:
                    best, cos = UNKNOWN, 0.0
                else:
                    near = model.centroids @ _unit(counts, model.idf)
                    best, cos = model.langs[int(near.argmax())], float(np.clip(near.max(), 0.0, 1.0))
                lang.append(best), score.append(cos), rejected.append(counts is None or cos < model.threshold * float(_reach((counts > 0).sum())))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(lang, pa.string()), pa.array(score), pa.array(rejected)], names=schema.names)

    return map_texts(docs, run, schema)
