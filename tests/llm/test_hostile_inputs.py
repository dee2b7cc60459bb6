"""Texts and tables made to hurt: equal polynomials, endless white space, rows without an id, languages with few documents, ties."""

import hashlib
import random

import numpy as np
import pytest
import tiktoken

from sunfleet.llm import mixing, ngram_join, quality_divergence, queries, suffix_dedup, token_counts
from sunfleet.llm.kernels import SpanHash


def thue_morse(n):
    a, b = b"a", b"b"
    while len(a) < n:
        a, b = a + b, b + a
    return a, b


@pytest.mark.parametrize("power", range(9, 15))
def test_strings_of_thue_and_morse_differ_in_hash(power):
    a, b = thue_morse(2**power)
    data = np.frombuffer(a + b + b" " + a, np.uint8)
    n = len(a)
    start = np.array([0, n, 2 * n + 1])
    first, second, again = SpanHash(data)(start, start + n)
    assert first != second and first == again


def test_span_hash_equals_its_definition():
    data = np.frombuffer(bytes(random.Random(1).choices(range(256), k=3000)) * 2, np.uint8)
    spans = SpanHash(data)
    start = np.arange(0, 2900, 37)
    assert (spans(start, start + 90) == spans(start + 3000, start + 3090)).all()
    assert len(np.unique(spans(start, start + 90))) == len(start)


def test_operators_tell_these_strings_apart(spark):
    a, b = (x.decode() for x in thue_morse(2048))
    docs = spark.createDataFrame([(1, f"{a}\n{b}\nx y", "en", "s"), (2, f"p {a} q", "en", "s"), (3, f"p {b} q", "en", "s")], "doc_id long, text string, lang string, source string")
    assert {r.doc_id: r.n_dup_lines for r in quality_divergence.quality(docs).collect()} == {1: 0, 2: 0, 3: 0}
    assert {r.component_id for r in ngram_join.similarity_components(docs.filter("doc_id > 1"), shingle=3, percent=90).collect()} == {2, 3}


@pytest.fixture(scope="module")
def encoding(spark):
    ranks = token_counts.read_ranks(spark, queries.VOCABULARY)
    return tiktoken.Encoding("test", pat_str=token_counts.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_long_white_space_is_cut_as_the_pattern_cuts_it(encoding, monkeypatch):
    r = random.Random(2)
    texts = []
    for _ in range(300):
        parts = []
        for _ in range(r.randint(1, 5)):
            parts += [r.choice(["", "word", "12", "it's", "!?", "é", "　x", "\x1c"]), "".join(r.choices(" \n\t\r  \x1c\x85", k=r.randint(0, 40))) or " " * r.randint(0, 60)]
        texts.append("".join(parts))
    want = [encoding.encode_ordinary(t) for t in texts]
    monkeypatch.setattr(token_counts, "LONG_SPACE", token_counts.re.compile(token_counts.LONG_SPACE.pattern.replace("20001", "7")))
    assert [token_counts.encode(encoding, t) for t in texts] == want


@pytest.mark.parametrize("space", [" ", "\n", " \n"])
def test_five_megabytes_of_white_space(encoding, space):
    run = space * (5_000_000 // len(space))
    ids = token_counts.encode(encoding, f"one two{run}three{run}")
    assert encoding.decode(ids) == f"one two{run}three{run}"


def test_endless_space_counts_in_a_job(spark):
    docs = spark.createDataFrame([(1, "title\nbody" + " " * 1_200_000 + "end"), (2, None), (3, "a b")], "doc_id long, text string")
    got = {r.doc_id: r for r in token_counts.section_tokens(docs, queries.VOCABULARY).collect()}
    assert got[2].n_tokens == 0 and got[1].n_tokens == sum(got[1].sections.values()) > 1000


@pytest.mark.parametrize("rule", ["first", "last", "share"])
def test_allocation_equals_counting_byte_by_byte(rule):
    r = random.Random(3)
    for _ in range(200):
        sizes = np.array([r.randint(1, 6) for _ in range(r.randint(1, 12))])
        total, at, sections = int(sizes.sum()), 0, []
        while at < total:
            at += r.randint(0, 3)
            stop = min(total, at + r.randint(1, 9))
            if stop > at:
                sections.append((r.choice("xyz"), at, stop))
            at = stop
        name = lambda p: next((n for n, a, b in sections if a <= p < b), "(none)")  # noqa: B023, E731
        place = lambda p: next((k for k, (_, a, b) in enumerate(sections) if a <= p < b), -1 - sum(b <= p for _, _, b in sections))  # noqa: B023, E731
        want, crossing, start = {}, 0, 0
        for size in sizes:
            inside = range(start, start + int(size))
            crossing += place(start) != place(start + size - 1)
            for p in [start] if rule == "first" else [start + size - 1] if rule == "last" else inside:
                want[name(p)] = want.get(name(p), 0) + (1 / size if rule == "share" else 1)
            start += size
        got, n = token_counts.allocate(sizes, sections, rule)
        assert n == crossing and {k: round(v, 9) for k, v in got.items()} == {k: round(v, 9) for k, v in want.items()}


def test_texts_without_an_id_are_told_apart(spark):
    r = random.Random(4)
    line = lambda: bytes(r.choices(b"abcdefghij ", k=150)).decode()
    shared = line()
    texts = [line() + line() for _ in range(2000)] + [line() + shared, line() + shared, shared]
    rows = [(None, t) for t in texts] + [(7, texts[0]), (8, "x" * 40 + texts[1]), (8, "x" * 40 + texts[1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = sorted((x.doc_id is None, x.doc_id or 0, x.n_bytes, x.n_removed, x.kept_sha256) for x in suffix_dedup.digests(docs).collect())
    # in the order of id and hash, missing ids last; equal rows are one document
    order = sorted({(d is None, d or 0, hashlib.sha256(t.encode()).digest(), t) for d, t in rows})
    seen, kept = set(), {}
    for missing, d, _, t in order:
        windows, cut = [t[i:i + 100] for i in range(len(t) - 99)], set()
        for i, w in enumerate(windows):
            if w in seen:
                cut |= set(range(i, i + 100))
            seen.add(w)
        kept[missing, d, t] = "".join(c for i, c in enumerate(t) if i not in cut)
    want = sorted((d is None, d or 0, len(t), len(t) - len(k := kept[d is None, d or 0, t]), hashlib.sha256(k.encode()).hexdigest()) for d, t in rows)
    assert got == want


def test_languages_with_few_documents_are_judged_by_the_base_rules(spark):
    r = random.Random(5)
    words = [bytes(r.choices(b"abcdefghijklm", k=5)).decode() for _ in range(300)]
    odd = ["".join(chr(r.randint(0x400, 0x44f)) for _ in range(5)) for _ in range(300)]
    rows = [(k, " ".join(r.choices(words, k=120)), "xx") for k in range(40)] + [(100 + k, " ".join(r.choices(odd, k=120)), lang) for k, lang in enumerate(["tail"] * 19 + [None])]
    got = quality_divergence.quality(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    assert all(x.kept for x in got)
    assert all((x.class_distance is None) == (x.doc_id >= 100) for x in got)


def test_ties_of_a_mix_go_by_the_whole_row(spark):
    rows = [(None, f"{w} text", "s") for w in "abcdefghij"] + [(5, f"{w} text", "t") for w in "klmnopqrst"] * 2
    runs = []
    for parts in (1, 3, 8):
        docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(parts)
        runs.append(sorted((x.text, x.copy) for x in mixing.mixed(docs).collect()))
    assert runs[0] == runs[1] == runs[2] and len(runs[0]) > len(rows) / 2


