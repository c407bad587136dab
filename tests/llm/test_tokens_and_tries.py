"""Operators 11 to 13 against brute force and the public libraries; odd inputs."""

import hashlib
import random
import zlib
from collections import Counter

import pytest

from carelint.llm import alignment, byte_level, trie
from carelint.llm.bpe import byte_letters
from carelint.llm.common import PIECES, TOKENIZER, tokenizer_path

ODD = [None, "", " ", "  two  spaces ", "plain words here", "plain words here", "a▁b", "<s> <unk> <|endoftext|> <0x41>", "日本語のテキスト", "x" * 3000, "naïve café 🙂🙂 \x1c\x00", "tab\tnew\n\n line ", "a 'b' it's 12 34"]


# ------------------------------------------------------------------------------- operator 11
def brute_trie(rows):
    digest = lambda r, x: hashlib.sha256(f"{len(r.encode())}:{r}{x}".encode()).digest()[:16]
    by = {}
    for c, t, r, x in rows:
        if c is not None:
            by.setdefault(c, []).append((t is not None, t or 0, r or "", digest(r or "", x or ""), x or ""))
    own = {c: [(v[2], v[4]) for v in sorted(vs)] for c, vs in by.items()}
    built = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = own.get(c - (c % 5 if c >= 0 else -(-c % 5)), [])[:h] + v[h:]
    members = {}
    for c, v in built.items():
        for d in range(len(v) + 1):
            members.setdefault(tuple(v[:d]), []).append(c)
    kids = Counter(k[:-1] for k in members if k)
    leaves, saved = Counter(), Counter()
    for k, m in members.items():
        for d in range(len(k) + 1):
            saved[k[:d]] += (len(m) - 1) * len(k[-1][1].encode()) if k else 0
            leaves[k[:d]] += not kids[k]
    ends = lambda k, m: ",".join(str(c) for c in sorted(m) if len(built[c]) == len(k))
    return sorted(((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), kids[k], leaves[k], saved[k], hashlib.sha256(ends(k, m).encode()).hexdigest()) for k, m in members.items()), key=str)


@pytest.fixture(scope="module")
def talks(spark):
    """Nulls, ties, repeated rows, negative ids, copies, a long conversation and columns named like the operator's own."""
    rnd, rows = random.Random(5), []
    for c in range(-12, 40):
        if c % 10:
            rows += [(c, rnd.choice([t, t, t, None]), rnd.choice(["user", "a", None]), rnd.choice(["x", "é", "", None])) for t in range(rnd.randint(0, 12))]
    rows += rows[:9] + [(None, 1, "u", "x")] * 5 + [(70, i, "u", f"t{i % 3}") for i in range(60)] + [(75, i, "u", f"t{i % 3}") for i in range(50)]
    schema = "conv_id long, turn long, role string, text string, depth string, node int, n string"
    return rows, spark.createDataFrame([(*r, "x", 1, "y") for r in rows], schema)


@pytest.mark.parametrize("tail", [1 << 15, 40])
def test_trie_equals_brute_force(talks, tail):
    rows, df = talks
    built = trie.rebuilt(trie.turns(df.select("conv_id", "turn", "role", "text")))
    assert sorted((tuple(r) for r in trie.trie(built, tail).collect()), key=str) == brute_trie(rows)


def test_trie_of_nothing(talks):
    assert trie.op11(talks[1].limit(0)).count() == 0


# ------------------------------------------------------------------------------- operator 12
def test_groups_and_links_of_ends():
    a, b = [2, 3, 7, 9], [1, 3, 4, 9]
    cuts = list(alignment.group_slices(a, b))
    assert cuts == [(0, 2, 0, 2), (2, 4, 2, 4)]
    assert [list(alignment.slice_links(a, b, *c)) for c in cuts] == [[(0, 0), (0, 1), (1, 1)], [(2, 2), (2, 3), (3, 3)]]


def brute_alignment(texts):
    import sentencepiece
    from tokenizers import Tokenizer

    lib, pieces = Tokenizer.from_file(tokenizer_path(TOKENIZER)), sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(PIECES))
    lib.encode_special_tokens = True
    letters, found, counts = byte_letters(), [], Counter()
    for t in texts:
        a, b = lib.encode(" " + (t or ""), add_special_tokens=False).ids, pieces.encode(t or "")
        as_a = [bytes(letters[c] for c in lib.id_to_token(i)) for i in a]
        as_b = [bytes([int(pieces.id_to_piece(i)[3:5], 16)]) if pieces.is_byte(i) else pieces.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not t or b"".join(as_a) != (" " + t).encode() or b"".join(as_b) != (" " + t).encode():
            found.append(None)
            continue
        at_a, at_b = [[(sum(map(len, x[:k])), sum(map(len, x[: k + 1]))) for k in range(len(x))] for x in (as_a, as_b)]
        ends = sorted({e for _, e in at_a} & {e for _, e in at_b})
        inside = lambda ids, at, s, e: ",".join(str(i) for i, (x, y) in zip(ids, at) if s <= x and y <= e)
        groups = ";".join(f"{inside(a, at_a, s, e)}|{inside(b, at_b, s, e)}" for s, e in zip([0, *ends], ends))
        links = [(i, j) for i, (p, q) in zip(a, at_a) for j, (r, s) in zip(b, at_b) if p < s and r < q]
        counts.update(links)
        found.append((len(a), len(b), len(ends), links, hashlib.sha256(groups.encode()).hexdigest()))
    best = Counter()
    for (_, j), n in counts.items():
        best[j] = max(best[j], n)
    return [(0, 0, 0, 0, 0, 0, "") if f is None else (*f[:3], len(f[3]), sum(counts[x] == best[x[1]] for x in f[3]), sum(counts[x] for x in f[3]), f[4]) for f in found]


@pytest.mark.parametrize("block", [1 << 20, 30])
def test_alignment_equals_brute_force(spark, block):
    rnd = random.Random(2)
    texts = ODD + [" ".join(rnd.choice(["the", "Thtion", "oues", "naïve", "12", "it's", "日本", "ing"]) + rnd.choice(["", "s", ",", "\n"]) for _ in range(rnd.randint(1, 40))) for _ in range(40)]
    rows = [(i if i % 7 else None, t, "x", 1, "u") for i, t in enumerate(texts)] + [(1, texts[4], "x", 1, "u")]
    df = spark.createDataFrame(rows, "doc_id long, text string, block string, pairs int, units string")
    got = Counter(tuple(r) for r in alignment.scores(df, block=block).collect())
    assert got == Counter((r[0], *w) for r, w in zip(rows, brute_alignment([r[1] for r in rows])))
    assert alignment.op12(df.limit(0)).count() == 0


def test_alignment_itself(spark):
    r = alignment.align(spark.createDataFrame([(1, "naïve café"), (2, None)], "doc_id long, text string")).orderBy("doc_id").collect()
    assert r[0].groups[-1].byte_end == len(" naïve café".encode()) and r[0].links[-1].a == len(r[0].a_ids) - 1 and r[1].links == []


# ------------------------------------------------------------------------------- operator 13
def test_byte_level_equals_tiktoken():
    import tiktoken

    path = tokenizer_path(byte_level.RANKS)
    own, ranks, rnd = byte_level.tokenizer(path), byte_level.ranked(path), random.Random(1)
    lib = tiktoken.Encoding("own", pat_str=byte_level.pattern(), mergeable_ranks=ranks, special_tokens={})
    texts = [t or "" for t in ODD] + ["".join(rnd.choice(["a", "b", " ", "  ", "'s", "\n", "\t", "é", "1", "=", "tion", "ing", "表", "\x1c", " ", "🙂", "<|endoftext|>"]) for _ in range(rnd.randint(0, 120))) for _ in range(1500)]
    texts += ["".join(rnd.choice("etaoinshr") for _ in range(rnd.randint(1, 60))) for _ in range(1500)] + ["a" * 5000, "ab" * 777 + "=" * 999, " " * 300]
    import numpy as np
    for t, packed in zip(texts, own.packed(texts)):
        ids = np.frombuffer(packed, "<u4").tolist()
        assert ids == lib.encode_ordinary(t) and own.decode_bytes(ids) == t.encode()
    for t in texts[:300]:
        ids, starts, ends = own.spans(t)
        assert ids.tolist() == lib.encode_ordinary(t)
        assert all(own.decode_bytes([i]) in t[s:e].encode() for i, s, e in zip(ids, starts, ends))
        assert "".join(own.decode_pieces(ids.tolist())) == t


def test_byte_level_tables(spark):
    rows = [(i if i % 5 else None, t, "x", "y", 3) for i, t in enumerate(ODD)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string, bytes string, same int")
    got = byte_level.op13(df)
    assert got.count() == len(rows) and got.where("not round_trip").count() == 0 and byte_level.op13(df.limit(0)).count() == 0
    back = byte_level.decode(byte_level.encode(df))
    assert Counter((r.doc_id, r.text, "".join(r.pieces), bytes(r.bytes)) for r in back.collect()) == Counter((r[0], r[1] or "", r[1] or "", (r[1] or "").encode()) for r in rows)
    split = byte_level.tokenizer(tokenizer_path(byte_level.RANKS))
    emoji = [i for b in "🙂".encode() for i in [byte_level.ranked(tokenizer_path(byte_level.RANKS))[bytes([b])]]]
    assert split.decode_pieces(emoji) == ["", "", "", "🙂"] and split.decode_pieces(emoji[:3])[-1] == "�"
