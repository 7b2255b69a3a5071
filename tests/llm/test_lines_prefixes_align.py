"""Line dedup, prefix trie and tokenizer alignment against plain Python."""

import collections
import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from rental_mart.llm import align, lines, prefixes
from rental_mart.llm.queries import vocabulary_path

WHITE, AZ = " \t\n\x0b\x0c\r", str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, id string, name string, bitmap int, line string, copies string, k1 string, n string, at int, h1 int"
CLASH = ("x", "y", 1, "z", "c", "k", "n", 2, 3)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, t, *CLASH) for i, t in rows], DOCS).repartition(parts)


def key(line):
    return line.strip(WHITE).translate(AZ)


def dropped_by_hand(rows, chars=40, docs=5):
    held = collections.defaultdict(set)
    order = lambda i: (i is not None, i or 0)
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= chars:
                held[key(line)].add(order(i))
    first = {k: max(ids) for k, ids in held.items() if len(ids) >= docs}
    out = []
    for i, text in rows:
        every = (text or "").split("\n")
        kept = [x for x in every if first.get(key(x), order(i)) == order(i)]
        out.append((i, len(every), len(every) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def line_rows():
    common = "The Common Line that many documents hold, é"  # 43 code points
    ascii_line = "ANOTHER line that is held by several documents"
    rows = [(i, f"{i} own line\n  {common}\t\nrest") for i in range(6)]
    rows += [(i, common.replace("C", "c") + "\r\n" + ascii_line.swapcase() * (i % 2) + "\n\n") for i in range(10, 30)]
    rows += [(31, None), (32, ""), (33, "\n"), (None, common), (None, f"x\n{common}"), (34, common), (34, common), (34, f"{common}\nanother text")]
    rows += [(35, "É" * 39), (36, "é" * 40), (37, "É" * 40), *((40 + i, "É" * 40) for i in range(5))]  # only A-Z have lower case
    rows += [(50 + i, "a" * 39 + "\n" + "k" * 40) for i in range(5 - 1)]  # too short; in too few documents
    rows += [(60, "\n".join([common if i in (0, 63, 64, 700, 4999) else f"line {i}" for i in range(5000)]))]  # long
    rows += [(61, "\n".join([common] * 200)), (62, "one\n" + common)]
    return rows


def test_lines(spark):
    rows = line_rows()
    got = lines.dedup(frame(spark, rows)).collect()
    assert sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], r["kept_text"]) for r in got), key=str) == dropped_by_hand(rows)
    long = next(r for r in got if r["doc_id"] == 60)
    assert [w["word"] for w in long["bitmap"]] == [0, 1, 10, 78]  # words of 64 lines that lose one
    assert lines.dedup(frame(spark, rows[:0])).count() == 0


def test_lines_random_over_any_partitioning(spark):
    rng = random.Random(7)
    pool = [("Shared " * 6 + str(i)) for i in range(6)] + ["short", "", "É" + "x" * 45]
    rows = [(rng.randrange(25), "\n".join(rng.choices(pool, k=rng.randrange(0, 9)))) for _ in range(60)]
    want = dropped_by_hand(rows, docs=3)
    for parts in (1, 7):
        got = lines.dedup(frame(spark, rows, parts), min_docs=3).collect()
        assert sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], r["kept_text"]) for r in got), key=str) == want


def test_lines_run_without_python_and_stream_the_ranges(spark):
    docs = frame(spark, line_rows())
    plan = lines.dedup(docs)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Arrow", "Python", "Pandas", "Cartesian", "NestedLoop"))
    counted = lines.counted_keys(lines.keyed_lines(docs, "doc_id", "text", 40))._jdf.queryExecution().executedPlan().toString()
    assert counted.count("rangepartitioning(h1") == 1 and counted.count("hashpartitioning") == 1
    assert "SortAggregate" in counted and "HashAggregate" not in counted


TURNS = "conv_id long, turn long, role string, text string, turns int, a string, kind int"


def trie_by_hand(rows):
    own = collections.defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    new = {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        new[c] = tuple(own.get(c - c % 5, [])[:h] + mine[h:])
    members = collections.defaultdict(list)
    for c in sorted(new):
        for d in range(len(new[c]) + 1):
            members[new[c][:d]].append(c)
    kids = collections.Counter(p[:-1] for p in members if p)
    leaves, saved = collections.Counter(), collections.Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += kids[p] == 0
            saved[p[:d]] += (len(m) - 1) * (len(p[-1][1].encode()) if p else 0)
    return sorted(
        (m[0], len(p), -1 if not p else members[p[:-1]][0], len(m), kids[p], leaves[p], saved[p], sha(",".join(str(c) for c in m if len(new[c]) == len(p))))
        for p, m in members.items()
    )


def conversations(seed, n):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        same = rng.random()
        length = 1 if same < 0.1 else rng.randrange(1, 12)
        for t in range(length):
            rows.append((c, t if t else rng.choice((0, None)), ["user", "assistant", None][t % 3], rng.choice(["é", "yes", None, "", "a longer text"]) if same < 0.8 else f"t{t}"))
    rows += [(-7, 0, "user", "negative"), (-3, 0, "user", "negative"), (None, 1, "user", "no id"), (3, 1, "user", "yes")]
    rows += [(2000, t, "user", "t") for t in range(150)] + [(2001, t, "user", "t") for t in range(90)]  # long, one below the other
    rows += [(4000 + i, t, "user", f"copy {t}") for i in range(300) for t in range(3)]  # copies over many shards
    return [r for r in rows if r[0] != 3] + [(3, 1, "user", "yes"), (3, 1, "user", "yes")]  # a repeated row


@pytest.mark.parametrize("shard_turns", [200_000, 60, 9])
def test_trie(spark, shard_turns):
    rows = conversations(shard_turns, 120)
    turns = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], TURNS).repartition(3)
    got = prefixes.trie(prefixes.rebuilt(prefixes.sequences(turns)), shard_turns).collect()
    columns = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    assert sorted(tuple(-1 if r[c] is None else r[c] for c in columns) for r in got) == trie_by_hand(rows)


def test_trie_of_nothing(spark):
    none = spark.createDataFrame([], TURNS)
    assert prefixes.trie(prefixes.rebuilt(prefixes.sequences(none))).count() == 0


def files():
    return vocabulary_path("byte_bpe_50k.json"), vocabulary_path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def vocabularies():
    import sentencepiece
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(files()[0]), sentencepiece.SentencePieceProcessor(model_file=files()[1])
    a.encode_special_tokens = True
    letter = {c: i for c, i in align._plain_bytes().items()}
    strings_a = {i: bytes(letter[c] for c in t) for t, i in a.get_vocab(with_added_tokens=False).items() if all(c in letter for c in t)}
    strings_b = [b.id_to_piece(i) for i in range(b.get_piece_size())]
    strings_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(strings_b)]
    return a, b, strings_a, strings_b


def aligned_by_hand(text, vocabularies):
    a, b, strings_a, strings_b = vocabularies
    ids_a = a.encode(" " + (text or ""), add_special_tokens=False).ids
    ids_b = b.encode(text or "")
    own = f" {text}".encode()
    if not text or b"".join(strings_a[i] for i in ids_a) != own or b"".join(strings_b[i] for i in ids_b) != own:
        return 0, 0, 0, 0, "", collections.Counter()

    def spans(ids, strings):
        at, out = 0, []
        for i in ids:
            out.append((at, at + len(strings[i]), i))
            at += len(strings[i])
        return out

    of_a, of_b = spans(ids_a, strings_a), spans(ids_b, strings_b)
    common = sorted({e for _, e, _ in of_a} & {e for _, e, _ in of_b})
    groups = [
        "|".join(",".join(str(i) for _, e, i in side if lo < e <= hi) for side in (of_a, of_b))
        for lo, hi in zip([0, *common], common)
    ]
    links = collections.Counter((i, j) for s, e, i in of_a for s2, e2, j in of_b if s < e2 and s2 < e)
    return len(ids_a), len(ids_b), len(common), sum(links.values()), sha(";".join(groups)), links


def align_rows():
    rng = random.Random(3)
    parts = list("aabbeeilnorst'.,!0123  \n\nİΣéß中🙂<|>\t\xa0　\x1c\r") + ["  ", "   ", "<|endoftext|>", "<s>", "<0x41>", " the", " of", " ", "\x00"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(1, 60))) for _ in range(300)]
    texts += ["a ▁ b", "▁", " ", "  x  ", "\n \n b", "x \n y", "the of the of " * 80, "word" * 300, "é é ﬁ"]
    rows = [(i, t) for i, t in enumerate(texts)]
    return rows + [(900, None), (901, ""), (None, "the text"), (902, "the text"), (902, "the text")]


def test_alignment(spark, vocabularies):
    rows = align_rows()
    by_hand = [(i, aligned_by_hand(t, vocabularies)) for i, t in rows]
    counts = collections.Counter(pair for _, x in by_hand for pair in x[5])
    best = collections.Counter()
    for (a, _), n in counts.items():
        best[a] = max(best[a], n)
    want = sorted(
        (str(i), *x[:5], sum(n for p, n in x[5].items() if counts[p] == best[p[0]]), sum(n * counts[p] for p, n in x[5].items())) for i, x in by_hand
    )
    assert sum(x[1] > 0 for x in want) > 200
    for slice_pairs in (align.SLICE_PAIRS, 500):
        got = align.alignment(frame(spark, rows), *files(), slice_pairs=slice_pairs).collect()
        columns = ("n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum")
        assert sorted((str(r["doc_id"]), *(r[c] for c in columns)) for r in got) == want
    assert align.alignment(frame(spark, rows[:0]), *files()).count() == 0


def test_alignment_with_a_small_cache(vocabularies, monkeypatch):
    monkeypatch.setattr(align, "CACHED_SEGMENTS", 20)
    aligner = align.Aligner(*(open(f, "rb").read() for f in files()))
    assert aligner.cuts
    texts = [t for _, t in align_rows() if t]
    for lo in range(0, len(texts), 40):
        part = texts[lo : lo + 40]
        sums, digests, offsets, pairs, times = aligner.texts(part)
        for k, text in enumerate(part):
            want = aligned_by_hand(text, vocabularies)
            mine = slice(offsets[k], offsets[k + 1])
            assert (*sums[k].tolist(), digests[k]) == want[:5]
            assert dict(zip(pairs[mine].tolist(), times[mine].tolist())) == {a << 32 | b: n for (a, b), n in want[5].items()}
    assert len(aligner.known) + len(aligner.older) < 2000


def test_segments_are_tokenised_together(vocabularies):
    """New segments go to the tokenizers as few strings; those beside a segment whose bytes get lost stay whole."""
    class Counting:
        def __init__(self, inner):
            self.inner, self.strings = inner, 0

        def encode_batch_fast(self, strings, **kw):
            self.strings += len(strings)
            return self.inner.encode_batch_fast(strings, **kw)

    aligner = align.Aligner(*(open(f, "rb").read() for f in files()))
    aligner.a = counting = Counting(aligner.a)
    lost = next(c for c in "ﬁ▁\x00é①" if aligned_by_hand(f"x{c}y", vocabularies)[0] == 0)
    texts = [" ".join(f"word{i}é" for i in range(1000)), " ".join(f"other{i}" + "　 \xa0x" * (i % 9 == 0) for i in range(50)),
             "so " + lost + " it", "is it", "  in  d \x1c e ", "\x85 a"]
    for k in range(0, len(texts), 2):
        sums, digests, offsets, pairs, times = aligner.texts(texts[k : k + 2])
        for i, text in enumerate(texts[k : k + 2]):
            want = aligned_by_hand(text, vocabularies)
            mine = slice(offsets[i], offsets[i + 1])
            assert (*sums[i].tolist(), digests[i]) == want[:5]
            assert dict(zip(pairs[mine].tolist(), times[mine].tolist())) == {a << 32 | b: n for (a, b), n in want[5].items()}
    assert counting.strings < 100
