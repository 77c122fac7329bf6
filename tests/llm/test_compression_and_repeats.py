"""Vector codes, repeated strings and periodic runs against brute force."""
import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq

from newsflow.llm import periodic_runs, queries, suffix_dedup, vector_codes
from newsflow.llm.common import mix64
from newsflow.session import apply_job_conf
from tests.conftest import SF_SMALL
from tests.llm.conftest import DOC_ROWS, VEC_ROWS


def test_limbs_and_products_are_exact():
    draws = np.random.default_rng(1)
    for top, width in ((3, 1), (2 ** 20, 4), (2 ** 29, 7), (2 ** 31 - 1, 2)):
        x, c = draws.integers(-top, top + 1, (30, width)), draws.integers(-top, top + 1, (9, width))
        x[0], c[0] = top, -top
        want = [[sum(int(a) * int(b) for a, b in zip(r, s, strict=True)) for s in c] for r in x]
        for bits in (None, 2, 5, 13):
            assert vector_codes.exact_dot(x, c, bits).tolist() == want
        for bits in (2, 9, 20):
            parts = vector_codes.limbs(x, bits)
            assert all(abs(p).max() <= 2 ** (bits - 1) for p in parts)
            assert [[sum(int(p[i, j]) << (bits * k) for k, p in enumerate(parts)) for j in range(width)] for i in range(30)] == x.tolist()
    assert all(w * 4 ** (vector_codes.limb_bits(w) - 1) < 2 ** 53 for w in range(1, 3000))


def test_integers_of_any_size():
    for v in (0.1, -0.1, 2.0 ** 40 + 0.5, -3e38, 1e308, 5e-324, -5e-324):
        x, far = vector_codes.to_integers(np.array([[v]]), 256, 2 ** 30)
        from fractions import Fraction
        assert (far[0] if 0 in far else x[0].tolist()) == [math.floor(Fraction(v) * 256)]


def brute_codes(rows, parts, entries, rounds, scale):
    from fractions import Fraction
    sound = [(i, v, y) for i, v, y in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = max(1, -(-max(len(v) for _, v, _ in sound) // parts)) * parts
    step = width // parts
    sound.sort(key=lambda r: (r[0] is None, r[0] or 0, [float(np.float32(x)) for x in r[1]]))
    ints = [[math.floor(Fraction(float(np.float32(x))) * scale) for x in v] + [0] * (width - len(v)) for _, v, _ in sound]
    cut = [[r[p * step:(p + 1) * step] for p in range(parts)] for r in ints]
    book = [[r[p] for r in cut[:entries]] for p in range(parts)]
    nearest = lambda p, x: min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), k) for k, e in enumerate(book[p]))
    for _ in range(rounds):
        new = []
        for p in range(parts):
            got = defaultdict(list)
            for r in cut:
                got[nearest(p, r[p])[1]].append(r[p])
            new.append([[sum(c) // len(got[k]) for c in zip(*got[k], strict=True)] if k in got else e for k, e in enumerate(book[p])])
        book = new
    out = []
    for (i, _, y), r in zip(sound, cut, strict=True):
        found = [nearest(p, r[p]) for p in range(parts)]
        out.append((i, y, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found)))
    total = defaultdict(int)
    for _, y, _, e in out:
        total[y] += e
    sha = hashlib.sha256(",".join(str(v) for p in book for e in p for v in e).encode()).hexdigest()
    fits = lambda y: all(e < 2 ** 63 for _, z, _, e in out if z == y) and total[y] < 2 ** 63
    return Counter((i, c, e if e < 2 ** 63 else None, total[y] if fits(y) else None, sha) for i, y, c, e in out)


def test_codes_equal_brute_force(spark, odd_dir):
    apply_job_conf(spark)
    got = queries.op11_vector_codes(spark, odd_dir).collect()
    assert Counter(map(tuple, got)) == brute_codes(VEC_ROWS, 16, 64, 2, 256)
    assert any(r.error is None for r in got)
    vectors = spark.read.parquet(f"{odd_dir}/embeddings.parquet").repartition(5)
    again = vector_codes.compress(vectors, parts=4, entries=200, rounds=3, scale=10)
    assert Counter((r.id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in again.collect()) == brute_codes(VEC_ROWS, 4, 200, 3, 10)


def brute_repeats(texts, window):
    at = defaultdict(list)
    for t, raw in enumerate(texts):
        for i in range(len(raw) - window + 1):
            at[raw[i:i + window]].append((t, i))
    cover = [np.zeros(len(raw), bool) for raw in texts]
    for places in at.values():
        if len(places) > 1:
            for t, i in places:
                cover[t][i:i + window] = True
    return cover


def runs_of_cover(cover):
    edges = np.flatnonzero(np.diff(np.r_[0, cover.astype(int), 0]))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))


def test_repeats_equal_brute_force(spark, monkeypatch):
    apply_job_conf(spark)
    draw = random.Random(4)
    noise = lambda n, letters="abcdefgh \u00e9": "".join(draw.choice(letters) for _ in range(n))
    passage, line = noise(150), noise(45)
    texts = [None, "", noise(39), noise(40), passage, "a" * 300, "ab" * 100 + noise(30) + "ab" * 60, noise(2000, "ab"), passage[:41], passage[1:40]]
    for k in range(60):
        t = noise(draw.randrange(20, 300))
        kind = k % 6
        if kind == 0:
            t = t[:50] + passage + t[50:]
        elif kind == 1:
            x = draw.randrange(100)
            t = t[:30] + passage[x:x + draw.randrange(30, 80)] + t[30:]
        elif kind == 2:
            t += line
        elif kind == 3:
            t = texts[-1]
        elif kind == 4 and texts[-1]:
            x = draw.randrange(len(texts[-1]))
            t = texts[-1][:x] + "X" + texts[-1][x + 1:]
        texts.append(t)
    raws = [(t or "").encode() for t in texts]
    want = brute_repeats(raws, 40)
    docs = spark.createDataFrame([(i % 50, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    expect = Counter((i % 50, len(raw), tuple(runs_of_cover(c)), bytes(np.frombuffer(raw, np.uint8)[~c])) for i, (raw, c) in enumerate(zip(raws, want, strict=True)))
    for batches, hot in ((1, 2000), (3, 3), (5, 0)):
        got = suffix_dedup.of_rows(docs, suffix_dedup.remove_repeats(docs, window=40, batches=batches, hot=hot)).collect()
        assert Counter((r.id, r.n_bytes, tuple((s.start, s.end) for s in r.spans or []), bytes(r.kept or b"")) for r in got) == expect


def test_pieces_hold_every_window_once_and_share_cores():
    draw = random.Random(2)
    raw = bytes(draw.choice(b"abc") for _ in range(3000)) + b"x" * 200
    for chunk in (1 << 20, 700, 64):
        seen, core_of = Counter(), {}
        for start, count, core, _ in suffix_dedup.pieces_of(raw, 40, chunk):
            for s, c, k in zip(start.tolist(), count.tolist(), core.tolist(), strict=True):
                for i in range(s, s + c):
                    seen[i] += 1
                    assert core_of.setdefault(raw[i:i + 40], k) == k
        assert seen == Counter(range(len(raw) - 39))


def test_levels_merge_geometrically(spark):
    apply_job_conf(spark)
    family = suffix_dedup.Family()
    for k in range(7):
        family.add(spark.range(10 * k, 10 * k + 12).selectExpr("id as core", "1L as places"))
    assert [size for size, _ in family.levels] == [2, 1, 0]
    assert sorted(r.core for r in family.repeated().collect()) == sorted(10 * k + d for k in range(1, 7) for d in (0, 1))


def brute_runs(words):
    n, out = len(words), set()
    for q in range(1, n // 4 + 1):
        i = q
        while i < n:
            j = i
            while j < n and words[j] == words[j - q]:
                j += 1
            s = words[i - q:j]
            if len(s) >= max(6, 4 * q) and j > i and min(p for p in range(1, q + 1) if all(s[t] == s[t - p] for t in range(p, len(s)))) == q:
                out.add((i - q, len(s), q))
            i = j + 1 if j == i else j
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_runs_equal_brute_force():
    draw = random.Random(3)
    for k in range(1500):
        n = draw.choice([0, 1, 5, 6, 7, 8, 30, 90, 200])
        words = [draw.randrange(draw.choice([1, 2, 3, 40])) for _ in range(n)]
        for _ in range(draw.randrange(4) if n > 20 else 0):
            a, p, m = draw.randrange(n), draw.randrange(1, 20), draw.randrange(n)
            for i in range(a + p, min(n, a + m)):
                words[i] = words[i - p]
        with np.errstate(over="ignore"):
            assert periodic_runs.runs_of(mix64(np.array(words, np.uint64) + np.uint64(5))) == brute_runs(words)


def brute_op13(doc_id, text):
    words = [w for w in _words(text)]
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(words), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2] or (r[1] * best[2] == best[1] * r[2] and (r[0], r[2]) < (best[0], best[2])):
            best = r
    gone = {i for a, b, q in runs for i in range(a + q, a + b)}
    s, b, q = best or (None,) * 3
    return (doc_id, len(runs), s, b, q, 1000 * b // q if best else None,
            hashlib.sha256("".join(f"{x},{y},{z}\n" for x, y, z in runs).encode()).hexdigest(),
            hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in gone).encode()).hexdigest())


def _words(text):
    import re
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_op13_equals_brute_force(spark, tmp_path):
    apply_job_conf(spark)
    rows = [(r[0], r[1]) for r in DOC_ROWS if len(r[1] or "") < 10_000]
    rows += [(i, " ".join(_words(t)[:400])) for i, t in pq.read_table(f"{SF_SMALL}/documents.parquet", columns=["doc_id", "text"]).to_pandas().itertuples(index=False)]
    pq.write_table(pa.table({"doc_id": pa.array([r[0] for r in rows], pa.int64()), "text": pa.array([r[1] for r in rows], pa.string())}), f"{tmp_path}/documents.parquet")
    got = queries.op13_periodic_runs(spark, str(tmp_path)).collect()
    assert Counter(map(tuple, got)) == Counter(brute_op13(*r) for r in rows)
    assert sum(r.n_runs > 0 for r in got) > 10


def test_hot_words_stay_linear():
    h = np.zeros(300_000, np.uint64)
    assert periodic_runs.runs_of(h) == [(0, 300_000, 1)]
    h = np.tile(mix64(np.arange(1, 1001, dtype=np.uint64)), 200)
    h[::7] = 1
    assert periodic_runs.runs_of(h) == [(0, 200_000, 7000)]
