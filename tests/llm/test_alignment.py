"""The alignment of two tokenizers against the libraries and a plain version."""

import hashlib
from collections import Counter

import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from public_tokenizers import path
from tokenizers import Tokenizer

from conftest import DATA
from llm_helpers import EDGE_TEXTS, edges, nothing  # noqa: F401
from tabloom.llm import alignment
from tabloom.llm.alignment import align_tokenizers, aligner
from tabloom.llm.queries import QUERIES

A, B = path("byte_bpe_50k.json"), path("piece_bpe_32k.model")
COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
TEXT = st.text(st.one_of(st.sampled_from(list("abest  \n\t#.1é\x00\x85\xa0▁ΣİٱЖ한漢😀<s>|")),
                         st.characters(codec="utf-8")), max_size=30)


@pytest.fixture(scope="module")
def slow():
    """Tokens and groups of a text, straight from the libraries."""
    known_a = Tokenizer.from_file(A)
    known_a.encode_special_tokens = True
    known_b = sentencepiece.SentencePieceProcessor(model_file=B)
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in shown}
    byte_of |= {chr(256 + k): b for k, b in enumerate(x for x in range(256) if x not in shown)}

    def tokens(text):
        a = known_a.encode(" " + text, add_special_tokens=False).ids
        b = known_b.encode(text)
        bytes_a = [bytes(byte_of[c] for c in known_a.id_to_token(i)) for i in a]
        bytes_b = [bytes([int(known_b.id_to_piece(i)[3:5], 16)]) if known_b.is_byte(i)
                   else known_b.id_to_piece(i).replace("▁", " ").encode() for i in b]
        whole = (" " + text).encode()
        if not text or b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
            return []
        groups, i, j, at_a, at_b = [], 0, 0, 0, 0
        while i < len(a):
            own = ([], [])
            while not own[0] or at_a != at_b:
                if at_a <= at_b:
                    own[0].append(a[i])
                    at_a += len(bytes_a[i])
                    i += 1
                else:
                    own[1].append(b[j])
                    at_b += len(bytes_b[j])
                    j += 1
            groups.append(own)
        return groups

    return tokens


def digest(groups):
    told = ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)
    return hashlib.sha256(told.encode()).hexdigest() if groups else ""


def slow_rows(rows, slow):
    groups = [slow(t or "") for _, t in rows]
    linked = [Counter((a, b) for own_a, own_b in g for a in own_a for b in own_b) for g in groups]
    counts = Counter(p for x in linked for p in x)
    highest = {}
    for (a, _), n in counts.items():
        highest[a] = max(highest.get(a, 0), n)
    return Counter((i, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(x.values()),
                    sum(n for p, n in x.items() if counts[p] == highest[p[0]]),
                    sum(n * counts[p] for p, n in x.items()), digest(g))
                   for (i, _), g, x in zip(rows, groups, linked, strict=True))


def found_rows(df):
    return Counter(tuple(r[c] for c in COLUMNS) for r in df.collect())


@settings(max_examples=150, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=5))
def test_texts(slow, texts):
    found = aligner(A, B).align([t.encode() for t in texts])
    for k, text in enumerate(texts):
        groups = slow(text)
        want = Counter((a, b) for x, y in groups for a in x for b in y)
        many = aligner(A, B).many_b
        assert {divmod(p, many): n for p, n in zip(
            found["links"][k].tolist(), found["times"][k].tolist(), strict=True)} == want
        assert found["groups_sha256"][k] == digest(groups)
        assert (found["n_groups"][k], found["n_links"][k]) == (len(groups), sum(want.values()))


def test_wide_groups(slow, monkeypatch):
    texts = [t for t in EDGE_TEXTS if t] + ["漢字" * 40, "x" * 500 + " y"]
    want = aligner(A, B).align([t.encode() for t in texts])
    monkeypatch.setattr(alignment, "WIDE", 0)
    found = aligner(A, B).align([t.encode() for t in texts])
    for k in range(len(texts)):
        assert found["links"][k].tolist() == want["links"][k].tolist()
        assert found["times"][k].tolist() == want["times"][k].tolist()
    assert found["n_links"].tolist() == want["n_links"].tolist()


def test_query(spark, table, slow):
    rows = [(r["doc_id"], r["text"]) for r in table("documents").collect()]
    assert found_rows(QUERIES["op11_alignment"](spark, DATA)) == slow_rows(rows, slow)


def test_edges(edges, nothing, slow):
    rows = [(r["doc_id"], r["text"]) for r in edges.select("doc_id", "text").collect()]
    for block in (1, 100, alignment.BLOCK_LINKS):
        assert found_rows(align_tokenizers(edges, A, B, block_links=block)) == slow_rows(rows, slow)
    assert align_tokenizers(nothing, A, B).count() == 0


def test_special_strings_and_lost_bytes(spark, slow):
    rows = [(1, "a<|endoftext|>b <s> </s> <unk>"), (2, "a▁b"), (3, "<|endoftext|>"), (4, "▁"),
            (5, "é" * 3_000 + " " * 5_000), (6, "a "), (7, " ")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = found_rows(align_tokenizers(df, A, B))
    assert found == slow_rows(rows, slow)
    assert (2, 0, 0, 0, 0, 0, 0, "") in found
