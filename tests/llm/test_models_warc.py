import base64
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import pytest
from conftest import odd_rows
from pyspark.sql import functions as F

from locuspark.llm import langid, secret_scan, toxicity
from locuspark.llm.queries import QUERIES, held_out
from locuspark.llm.warc import END, read_archive, record_index, write_archive

SF = "/root/testdata/sf0.01"
SMALL = "/root/testdata/sf0.001"


# ---------------------------------------------------------------- secrets
def plain_base(text):
    """The three rules, each scanned over the whole text on its own, failing matches dropped afterwards."""
    text, out = text or "", []
    kw = "|".join("".join(f"[{c}{c.upper()}]" for c in w) for w in ("password", "passwd", "secret", "token"))
    assign = re.compile(f"({kw}|[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
    for k, rule in enumerate((assign, re.compile("AKIA[A-Z0-9]+"), re.compile("[0-9a-f]+"))):
        for m in rule.finditer(text):
            if len(m[2] if k == 0 else m[0]) >= (8, 16, 32)[k]:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def test_rules_match_plain_scan():
    rng = random.Random(4)
    bits = ["password", "PassWd", "token", "secret", "API_key", "apikey", " ", ":", "=", " = ", '"', "'", "\n", "AKIA", "é",
            "0123456789abcdef", "ABCDEF", "deadbeef", "x", "-", "ſecret", "toKen"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(40))) for _ in range(3000)]
    texts += [r[1] or "" for r in odd_rows()] + ["token: secret: abcdefghij", "AKIA" * 8, "a" * 32 + "A" * 40]
    for t in texts:
        assert secret_scan.rule_spans(t)[0] == plain_base(t), t


def findings(seed, n=240):
    """Keys after a masked word against plain words: (text, start, end, whether a key)."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        key = i % 2 == 0
        value = "".join(rng.choice("ABCDEFGHabcdefgh0123456789") if key else rng.choice("aeiounrstl")
                        for _ in range(rng.randrange(8, 40)))
        head = rng.choice(["my token = ", "some words "]) if key else "some words "
        out.append((f"{head}{value} and more", len(head), len(head) + len(value), float(key)))
    return out


def fitted(seed=2):
    rows = findings(seed)
    found = [secret_scan.finding(*secret_scan.codes_of(t), a, b) for t, a, b, _ in rows]
    return secret_scan.fit(found, np.array([y for *_, y in rows])), found, rows


def test_network_gradients():
    net, found, rows = fitted()
    found, y = found[:5], np.array([r[3] for r in rows[:5]])

    def loss():
        z = net.forward(found)[0]
        return float((np.log1p(np.exp(z)) - y * z).mean())

    for p, g in zip(net.params(), net.gradients(found, y)):
        for at in list(np.ndindex(p.shape))[:: max(1, p.size // 40)]:
            old, step = p[at], 1e-6
            p[at] = old + step
            up = loss()
            p[at] = old - step
            down = loss()
            p[at] = old
            assert abs((up - down) / (2 * step) - g[at]) < 1e-4


def test_network_learns_and_keeps_recall():
    net, found, rows = fitted()
    p, y = net.chance(net.forward(found)[0]), np.array([r[3] for r in rows])
    assert ((p >= net.threshold) == (y == 1)).mean() > 0.95
    assert net.recall >= secret_scan.RECALL and net.precision > 0.9


def test_texts_score_as_findings_do(monkeypatch):
    """Candidates of a text, convolved slice by slice, score as if each were read alone; words of the rule are masked."""
    net, _, rows = fitted()
    text = " ".join(t for t, *_ in rows[:40]) + " token: " + "x1" * 300 + " é😀 lastcandidate9"
    spans = [m.span() for m in secret_scan.RUN.finditer(text)]
    codes, masked = secret_scan.codes_of(text)
    alone = [net.chance(net.forward([secret_scan.finding(codes, masked, a, b)])[0])[0] for a, b in spans]
    for size in (1 << 16, 100, 7):
        monkeypatch.setattr(secret_scan, "SLICE", size)
        assert np.allclose(net.scores(codes, masked, spans, net.tables()), alone, atol=1e-4)
    one = [secret_scan.finding(*secret_scan.codes_of(f"{w} = abcd1234 x"), len(w) + 3, len(w) + 11) for w in ("tokenx", "secret")]
    assert one[0][:secret_scan.AROUND].lstrip(b"\0")[:1] == b"x" and one[1][:secret_scan.AROUND].lstrip(b"\0") == b" = "
    whole = secret_scan.codes_of("say token = abcd1234 x")
    assert secret_scan.finding(*whole, 12, 20, 4) == secret_scan.finding(*secret_scan.codes_of("say abcd1234 x"), 4, 12)


def test_keys_without_a_label_are_found(spark):
    """Planted keys that no rule knows, in prose: found by the network, which learned from labelled ones."""
    rng = random.Random(11)
    prose = lambda n: " ".join("".join(rng.choice("aeiounrstlmd") for _ in range(rng.randrange(3, 13))) for _ in range(n))
    key = lambda: "".join(rng.choice("ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnpqrstuvwxyz23456789") for _ in range(24))
    docs, planted = [], {}
    for i in range(300):
        value, head = key(), prose(40)
        text = f"{head} {'password = ' if i % 3 == 0 else ''}{value if i % 3 < 2 else prose(3)} {prose(40)}"
        if i % 3 == 1:
            planted[i] = (len(head) + 1, len(head) + 25)
        docs.append((i, text))
    rows = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in
            secret_scan.secret_spans(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    hits = sum(("model", *planted[i]) in rows[i] for i in planted)
    clean = sum(any(k == "model" for k, *_ in rows[i]) for i in range(300) if i % 3 != 1)
    assert hits >= 0.9 * len(planted) and clean <= 20


def test_gradients_of_joined_texts():
    """Texts convolved together give the gradients of findings read one by one; also where a candidate is cut into slices."""
    net = fitted()[0]
    rng = random.Random(5)
    value = lambda n: "".join(rng.choice("ABCabc0123") for _ in range(n))
    texts = [f"some words candidate{i} token = {value(rng.choice([9, 40, 300, 40_000]))} and secret words {value(12)}" for i in range(12)]
    now, alone = secret_scan.Joined(), []
    for t in texts:
        spans, others = secret_scan.rule_spans(t)
        codes = secret_scan.codes_of(t)
        alone += [secret_scan.finding(*codes, a, b) for a, b in others]
        alone += [secret_scan.finding(*codes, *v) for v in secret_scan.values_of(t, spans)]
        now.text(t)
    y, weight = np.array(now.marks, float), np.ones(len(alone)) / len(alone)
    assert y.sum() == len(texts)
    for got, want in zip(net.slopes(*now.pooled(net, net.tables(), True), y, weight), net.gradients(alone, y)):
        assert np.allclose(got, want, atol=1e-5)


def test_model_is_fitted_on_all_documents(spark):
    """A hundred of 600 documents give the first weights; all findings train, and all that are kept out set the threshold."""
    rng = random.Random(12)
    prose = lambda n: " ".join("".join(rng.choice("aeiounrstlmd") for _ in range(rng.randrange(3, 13))) for _ in range(n))
    key = lambda n: "".join(rng.choice("ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnpqrstuvwxyz23456789") for _ in range(n))
    docs = [(i, f"{prose(30)} {f'password = {key(rng.choice([9, 24, 700]))} ' if i % 3 == 0 else ''}{prose(30)}") for i in range(600)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    net = secret_scan.train(df, sample_docs=100)
    logit, mark, trained = [], [], 0
    for _, t in docs:
        now = secret_scan.Joined()
        now.text(t)
        if zlib.crc32(t.encode()) % secret_scan.FOLDS:
            trained += len(now.marks)
        else:
            logit += net.logits(now.pooled(net, net.tables())[0]).tolist()
            mark += now.marks
    p, y = net.chance(np.floor(np.array(logit) * secret_scan.BINS) / secret_scan.BINS), np.array(mark)
    assert y.sum() > 20 and net.seen == trained
    assert net.threshold == np.sort(p[y == 1])[int((1 - secret_scan.RECALL) * y.sum())]
    assert net.recall == (p[y == 1] >= net.threshold).mean() and abs(net.precision - y[p >= net.threshold].mean()) < 1e-9


def test_secret_spans_odd(spark, odd, none):
    """Base spans as the rules say, on one finding of each kind; other spans are the network's and touch no rule's."""
    got = Counter((r.doc_id, tuple((s.kind, s.start, s.end) for s in r.spans if s.kind != "model")) for r in
                  secret_scan.secret_spans(odd).collect())
    want = Counter((d, tuple((secret_scan.KINDS[k], a, b) for a, k, b in plain_base(t))) for d, t, _, _ in odd_rows())
    assert got == want
    assert secret_scan.secret_spans(none).count() == 0
    plain = spark.createDataFrame([(1, "nothing to find here, candidates notwithstanding"), (2, None)], "doc_id long, text string")
    assert all(r.spans == [] for r in secret_scan.secret_spans(plain).collect())


def test_secret_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in QUERIES["op4_secrets"](spark, SF).collect():
        own = plain_base(docs[r.doc_id])
        text = ",".join(f"{secret_scan.KINDS[k]}:{a}:{b}" for a, k, b in own)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == x for _, k, _ in own) for x in range(3)]
        assert [s for s in r.spans.split(",") if s and not s.startswith("model")] == [s for s in text.split(",") if s]


# ---------------------------------------------------------------- language
def test_langid_odd(odd, none):
    rows = langid.identify(odd, F.lit(False)).collect()
    assert Counter(r.doc_id for r in rows) == Counter(r[0] for r in odd_rows())
    assert all(0 <= r.score <= 1 for r in rows)
    und = {r.doc_id for r in rows if r.lang_pred == "und"}
    assert und >= {2, 3, 4, 5, -1} and not und & {6, 7, 10, 13, 14}
    assert langid.identify(none, F.lit(False)).count() == 0
    assert {r.lang_pred for r in langid.identify(odd, F.lit(True)).collect()} == {"und"}


def test_langid_held_out_accuracy(spark):
    got = QUERIES["op5_langid"](spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet"), "doc_id").collect()
    own = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert sum(r.lang_pred == r.lang for r in own) / len(own) > 0.97


def test_ngrams_ignore_case_and_signs():
    assert (langid.ngrams("Été, 12 là!") == langid.ngrams("été là")).all() or \
        sorted(langid.ngrams("Été, 12 là!")) == sorted(langid.ngrams(" été   là "))
    assert len(langid.ngrams("123 !?")) == 0 and langid.ngrams("xyz").max() < langid.FEATURES


def test_ftrl_is_sparse_and_separates():
    rng = np.random.default_rng(3)
    x = [(np.array([y, 2 + int(rng.integers(50))]), np.array([1.0, 0.2])) for y in (0, 1) * 200]
    y = np.array([v[0][0] for v in x])
    w = langid.ftrl(x, y, 2, 60)
    assert all((w[:, i] @ v).argmax() == t for (i, v), t in zip(x, y))
    assert (w[:, 52:] == 0).all()
    logits = np.array([w[:, i] @ v for i, v in x])
    assert abs(langid.best_temperature(logits * 3, y) / langid.best_temperature(logits, y) - 3) < 0.2 \
        or langid.best_temperature(logits, y) < 0.03


# ---------------------------------------------------------------- toxicity
def test_block_max_search_is_exact():
    rng = np.random.default_rng(6)
    terms = [f"={i}" for i in range(30)]
    bags = [Counter({terms[t]: int(rng.integers(1, 4)) for t in rng.choice(30, rng.integers(0, 5))}) for _ in range(300)]
    toxic = rng.integers(0, 2, 300)
    index = toxicity.build_index(list(range(300)), bags, toxic, np.ones(300), {t: 1 + i / 9 for i, t in enumerate(terms)}, 7)
    vectors = np.array([index.vector(b) for b in bags])
    for i in range(0, 300, 7):
        for leave in (-1, i):
            got, want = index.nearest(vectors[i], 7, leave), brute.cosine_neighbours(vectors, vectors[i], 7, leave)
            assert np.allclose([s for _, s in got], [s for _, s in want])
            edge = want[-1][1] + 1e-9 if want else 0
            assert {j for j, s in got if s > edge} == {j for j, s in want if s > edge}


def test_toxicity_odd(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (7, None), (8, 0), (9, 0), (99, 0)], "doc_id long, toxic int")
    got = toxicity.toxicity(odd, labels)
    assert got.columns[:-2] == odd.columns
    assert Counter((r.doc_id, r.text) for r in got.collect()) == Counter((r[0], r[1]) for r in odd_rows())
    assert got.where("_tox_score is null or _tox_score < 0 or _tox_score > 1").count() == 0
    assert toxicity.toxicity(none, labels).count() == 0
    assert {r._tox_score for r in toxicity.toxicity(odd, labels.limit(0)).collect()} == {0.0}


def test_toxicity_held_out(spark):
    got = QUERIES["op8_toxicity"](spark, "/root/testdata/sf0.1").join(
        spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id").where("held_out").collect()
    hit = sum(r.predicted for r in got if r.toxic)
    assert hit / sum(r.toxic for r in got) > 0.8
    assert sum(r.predicted for r in got if not r.toxic) / sum(not r.toxic for r in got) < 0.02
    assert any(r._tox_evidence for r in got if r.predicted)


def test_prefix_terms():
    got = toxicity.terms_of([b"abcd", b"abce", b"abcd"])
    assert got["=abcd"] == 2 and got["^abc"] == 3 and got["2abc"] == 1 and "2abcd" not in got


def plain_terms(bags, toxic, most):
    """The forward choice of terms, by sets on one machine."""
    held = [set(toxicity.terms_of(b)) for b in bags]
    open_, clean = ([h for h, y in zip(held, toxic) if y == c] for c in (1, 0))
    count, other = Counter(t for h in open_ for t in h), Counter(t for h in clean for t in h)
    least, all_ = np.log(1 + len(count)), len(open_)
    rate = {t: (other[t] + 0.5) / (len(clean) + 1) for t in count}
    can = {t for t, n in count.items() if n >= toxicity.LEAST and -n * np.log(rate[t]) >= least}
    sure = sorted((t for t in can if count[t] >= toxicity.WIDE * all_ and count[t] / all_ > toxicity.RATIO * rate[t]),
                  key=lambda t: (rate[t] / count[t], t))
    chosen = []
    while open_ and len(chosen) < most:
        left = Counter(t for h in open_ for t in h & can)
        gain, term = max(((n * np.log(n / len(open_) / rate[t]), t) for t, n in left.items() if n >= toxicity.LEAST),
                         default=(-1, ""))
        if gain < least:
            break
        chosen.append(term)
        open_ = [h for h in open_ if term not in h]
    return list(dict.fromkeys(chosen + sure))[:most]


def test_terms_counted_on_spark(spark):
    assert toxicity.EXAMPLES >= 3000
    rng = np.random.default_rng(3)
    toxic = np.arange(400) % 2
    bags = [[f"w{w}".encode() for w in rng.zipf(1.3, 40) if w < 5000] + [f"insult{rng.integers(9)}".encode()] * int(y)
            for y in toxic]
    rows = spark.createDataFrame([(i, b) for i, b in enumerate(bags)], "rid long, words array<binary>").repartition(5)
    kept = [frozenset(np.flatnonzero(toxic == y).tolist()) for y in (1, 0)]
    for most in (toxicity.TERMS, 3):
        got = toxicity.find_terms(rows, *kept, most)
        assert got == plain_terms(bags, toxic, most) and got


def test_only_verified_copies_fold():
    """Examples that share one rare word all stay; near copies fold, within their class only."""
    rng = np.random.default_rng(8)
    texts = [rng.integers(-2 ** 63, 2 ** 63, 50) for _ in range(60)]
    shared = [np.append(-2 ** 63 if i < 3 else t[0], t[1:]) for i, t in enumerate(texts)]
    copies = [np.append(texts[7][:-2], rng.integers(0, 2 ** 63, 2)) for _ in range(20)]
    marks = [m.astype(np.int64) for m in shared + copies + [texts[7]]]
    toxic = np.array([i % 2 for i in range(60)] + [1] * 20 + [0])
    assert toxicity.one_of_each(marks, toxic) == [*range(60), 80]
    assert toxicity.one_of_each(marks, np.ones(81, int)) == [*range(60)]
    assert toxicity.one_of_each([np.zeros(0, np.int64)] * 3, np.array([0, 1, 0])) == [0, 1]


# ---------------------------------------------------------------- WARC
PAGES = [(5, "http://a/", "same"), (3, None, "same"), (3, "http://b/\r\nX: y", "same"), (None, "u", "same"), (9, "u", None),
         (8, "u", ""), (7, "é", "\U0001F600\r\n\r\nWARC/1.1\r\n"), (1, "u", "x" * 300_000), (None, None, "only here")]


def test_warc_odd(spark, tmp_path):
    pages = spark.createDataFrame([(*p, "c", "d") for p in PAGES],
                                  "page_id long, url string, html string, digest string, body string").repartition(4)
    write_archive(pages, str(tmp_path / "a"))
    records = read_archive(spark, str(tmp_path / "a")).collect()
    groups = defaultdict(list)
    for p, _, h in PAGES:
        groups[h or ""].append(p)
    assert spark.read.parquet(str(tmp_path / "a" / "payloads")).count() == len(groups)
    first = {h: min((p for p in own if p is not None), default=None) for h, own in groups.items()}
    got = record_index(spark.createDataFrame(records)).collect()
    assert Counter(r.page_id for r in got) == Counter(p[0] for p in PAGES)
    by_sha = {base64.b32encode(hashlib.sha1(h.encode()).digest()).decode(): h for h in groups}
    kinds = defaultdict(list)
    for r in got:
        h = by_sha[r.payload_digest]
        kinds[h].append(r.record_type)
        assert r.payload_bytes == len(h.encode())
        assert r.page_id == first[h] if r.record_type == "response" else r.refers_to == first[h]
    assert all(sorted(k) == ["response"] + ["revisit"] * (len(k) - 1) for k in kinds.values())
    for r in records:
        head, _, body = bytes(r.record).partition(END)
        size = int(re.search(rb"Content-Length: (\d+)", head)[1])
        assert head.startswith(b"WARC/1.1\r\n") and body[size:] == END and b"\nX: y" not in head


def test_warc_threshold_and_empty(spark, tmp_path):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    write_archive(pages, str(tmp_path / "b"), min_bytes=5)
    got = record_index(read_archive(spark, str(tmp_path / "b"))).collect()
    assert {r.record_type for r in got} == {"response"} and len(got) == len(PAGES)
    write_archive(pages.limit(0), str(tmp_path / "c"))
    assert record_index(read_archive(spark, str(tmp_path / "c"))).count() == 0


def test_warc_damage_is_noticed(spark, tmp_path):
    path = str(tmp_path / "d")
    write_archive(spark.createDataFrame([(1, "u", "text")], "page_id long, url string, html string"), path)
    import zstandard
    bad = bytearray(zstandard.ZstdCompressor().compress(b"tExt"))
    spark.read.parquet(f"{path}/payloads").withColumn("body", F.lit(bad)).write.parquet(f"{path}/damaged")
    damaged = spark.read.parquet(f"{path}/damaged").collect()
    spark.createDataFrame(damaged, "digest string, n_bytes long, body binary").write.mode("overwrite").parquet(
        f"{path}/payloads")
    with pytest.raises(Exception, match="does not match"):
        read_archive(spark, path).collect()


def test_held_out_rule(spark):
    got = spark.createDataFrame([(i,) for i in range(50)] + [(None,)], "doc_id long").select("doc_id", held_out().alias("x"))
    for r in got.collect():
        assert r.x == (zlib.crc32(b"" if r.doc_id is None else str(r.doc_id).encode()) % 5 == 0)


def test_repeated_ids_do_not_grow_the_sample(spark, monkeypatch):
    """Fifty labelled ids, each on hundreds of rows with other texts: one example for each id."""
    docs = spark.range(20_000).select((F.col("id") % 50).alias("doc_id"), F.concat(
        F.when(F.col("id") % 50 < 25, F.lit("you awful fool ")).otherwise(F.lit("a calm day ")), F.col("id").cast("string")).alias("text"))
    labels = spark.range(50).select(F.col("id").alias("doc_id"), (F.col("id") < 25).cast("int").alias("toxic"))
    index = toxicity.train(docs, labels, most=50)
    assert sorted(index.ids) == list(range(50))
    model = langid.train(docs.withColumn("lang", F.when(F.col("doc_id") < 25, "x").otherwise("y")), most=40)
    assert model.langs == ["x", "y"]
