import hashlib
import random
from collections import Counter

import pytest
import sentencepiece
import tokenizers
from conftest import odd_rows

from locuspark.llm import alignment
from locuspark.llm.queries import QUERIES

SF, SMALL = "/root/testdata/sf0.01", "/root/testdata/sf0.001"
A_FILE, B_FILE = f"{alignment.TOKENIZERS}/byte_bpe_50k.json", f"{alignment.TOKENIZERS}/piece_bpe_32k.model"
HARD = ["", " ", "  ", "a ", " a", "\n  x", "a \n b  ", "x▁y", "▁", "<|endoftext|> a <s> </s> <unk> <0x41>", "a\x00b",
        "\xa0b \xa0 c  d᠎ e\x1c f", "é é ﬁ ① 😀😀 ﷽ 漢字かな 안녕", "don't we'll  I'm", "\t\t a\r\n b", "1 234 567 8",
        "word" * 300, "=" * 500, " " * 400, "Ā Ġ Ċ"]


@pytest.fixture(scope="module")
def encoders():
    a = tokenizers.Tokenizer.from_file(A_FILE)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B_FILE)


def tokens_plain(encoders, text):
    """Whole texts, encoded at once; bytes from the published rules of the two vocabularies."""
    a, b = encoders
    if not text:
        return [], []
    letters = [*range(33, 127), *range(161, 173), *range(174, 256)]
    place = {chr(c): c for c in letters}
    for c in range(256):
        if c not in letters:
            place[chr(256 + len(place) - len(letters))] = c
    a_tokens = [(i, bytes(place[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    b_tokens = [(i, bytes.fromhex(p[3:5]) if b.is_byte(i) else p.replace("▁", " ").encode())
                for i in b.encode(text) for p in [b.id_to_piece(i)]]
    raw = (" " + text).encode()
    if any(b"".join(x for _, x in t) != raw for t in (a_tokens, b_tokens)):
        return [], []
    return a_tokens, b_tokens


def plain(encoders, docs):
    links, rows = [], []
    for doc_id, text in docs:
        sides = []
        for tokens in tokens_plain(encoders, text):
            spans, at = [], 0
            for i, raw in tokens:
                spans.append((i, at, at + len(raw)))
                at += len(raw)
            sides.append(spans)
        a, b = sides
        ends = sorted({e for *_, e in a} & {e for *_, e in b})
        groups = []
        rest = [list(reversed(a)), list(reversed(b))]
        for e in ends:
            parts = []
            for side in rest:
                parts.append([])
                while side and side[-1][2] <= e:
                    parts[-1].append(str(side.pop()[0]))
            groups.append("|".join(",".join(x) for x in parts))
        j, own = 0, []
        for i, s, e in a:
            while j < len(b) and b[j][2] <= s:
                j += 1
            k = j
            while k < len(b) and b[k][1] < e:
                own.append((i, b[k][0]))
                k += 1
        links.append(own)
        rows.append((doc_id, len(a), len(b), len(groups), groups))
    count = Counter(x for own in links for x in own)
    most = Counter()
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    return [(d, na, nb, ng, len(own), sum(count[x] == most[x[1]] for x in own), sum(count[x] for x in own),
             hashlib.sha256(";".join(groups).encode()).hexdigest() if na else "")
            for (d, na, nb, ng, groups), own in zip(rows, links)], count, most


def same(got, want):
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_pieces_give_what_whole_texts_give(encoders):
    aligner = alignment.Aligner(open(A_FILE, encoding="utf-8").read(), open(B_FILE, "rb").read())
    assert aligner.cuts
    rng = random.Random(2)
    bits = [" ", "  ", "\n", "\t", "the", "é", "'s", "\xa0", "12", "!!", "漢", "😀", " ", "᠎", "\x85", "Ġ", "a", "ing"]
    texts = HARD + ["".join(rng.choice(bits) for _ in range(rng.randrange(1, 30))) for _ in range(1500)]
    for text in texts:
        if not text:
            continue
        pieces = aligner.pieces(text)
        assert "".join(pieces) == " " + text
        a = [i for p in pieces for i in aligner.a.encode(p, add_special_tokens=False).ids]
        b = [i for p in pieces for i in ([aligner.b_space] if p == " " else aligner.b.encode(p[1:]))]
        assert a == encoders[0].encode(" " + text, add_special_tokens=False).ids, repr(text)
        assert b == encoders[1].encode(text), repr(text)


@pytest.mark.parametrize("run_bytes, fan, cache", [(8 << 20, 64, 8 << 20), (40, 2, 200), (1, 3, 0)])
def test_against_plain(spark, encoders, monkeypatch, run_bytes, fan, cache):
    """One run or many, merged in one level or several, with and without remembered pieces."""
    docs = [(i, t) for i, t in enumerate(HARD * 2)] + [(None, None), (None, "the the the"), (7, "the cat"), (7, "the cat")]
    want, count, most = plain(encoders, docs)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    # the tasks have modules of their own, so the small sizes are set where they run
    run = alignment._spill

    def with_sizes(files, radix):
        inner = run(files, radix)

        def task(batches):
            alignment.RUN_BYTES, alignment.CACHE_CHARS = run_bytes, cache
            try:
                yield from inner(batches)
            finally:
                alignment.RUN_BYTES, alignment.CACHE_CHARS = 8 << 20, 8 << 20
        return task
    monkeypatch.setattr(alignment, "_spill", with_sizes)
    same(alignment.align(frame, radix=5, fan=fan).collect(), want)
    if run_bytes > 40:
        got = {(r["a"], r["b"]): (r["links"], r["best"]) for r in alignment.pair_counts(frame).collect()}
        assert got == {k: (n, n == most[k[1]]) for k, n in count.items()}


def test_odd_rows(spark, encoders, odd, none):
    same(alignment.align(odd).collect(), plain(encoders, [(r[0], r[1]) for r in odd_rows()])[0])
    assert alignment.align(none).count() == 0


def test_files_without_safe_cuts(spark, encoders):
    aligner = alignment.Aligner(open(A_FILE, encoding="utf-8").read(), open(B_FILE, "rb").read())
    aligner.cuts = False
    assert aligner.pieces("a b  c") == [" a b  c"]
    aligner.learn([[" a b  c"]])
    n = aligner.number[" a b  c"]
    whole = plain(encoders, [(1, "a b  c")])[0][0]
    assert (aligner.n_a[n], aligner.n_b[n], aligner.n_groups[n], aligner.first[n + 1] - aligner.first[n]) == whole[1:5]


def test_merge_is_streamed_and_sums():
    rng = random.Random(1)
    runs = [sorted(Counter(rng.randrange(5) << 32 | rng.randrange(9) for _ in range(40)).items()) for _ in range(7)]
    total = Counter()
    for r in runs:
        total.update(dict(r))
    blobs = [alignment._entries_blob([c for c, _ in r], [n for _, n in r]) for r in runs]
    codes, counts, best = alignment.with_maxima(alignment.merged([alignment._entries(b) for b in blobs]))
    assert list(zip(codes, counts)) == sorted(total.items())
    assert list(best) == [int(n == max(m for d, m in total.items() if d >> 32 == c >> 32)) for c, n in sorted(total.items())]


def test_query_against_plain(spark, encoders):
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    same(QUERIES["op12_token_alignment"](spark, SMALL).collect(), plain(encoders, docs)[0])
