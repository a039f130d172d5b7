"""Words looked up and pieces encoded many at a time, against one at a time."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from larkspar.llm import token_output
from larkspar.llm.alignment import BytePairs, Pieces
from larkspar.llm.queries import PIECES, tokenizer_path
from larkspar.llm.token_output import Encoder
from larkspar.llm.toxicity import SHORTEST, STEMS, Lexicon, Shared, deletions

LETTERS = "abcdeé日"


def words(rng, n, least=0, most=14):
    return ["".join(rng.choices(LETTERS, k=rng.randint(least, most))) for _ in range(n)]


def test_shared_strings():
    rng = random.Random(1)
    terms = words(rng, 40, 4, 12)
    for edits in (1, 2):
        near = set().union(*(deletions(t, edits) for t in terms))
        some = words(rng, 3000) + terms + [t[:-1] for t in terms] + [t + "e" for t in terms] + [t[1:-1] for t in terms]
        want = [not near.isdisjoint(deletions(w, edits)) for w in some]
        assert Shared(near).any_of(some, edits).tolist() == want and 50 < sum(want) < len(want)
    stems = set().union(*(deletions(t[: rng.choice(STEMS)], 1) for t in terms))
    sizes = range(STEMS[0] - 1, STEMS[-1] + 1)
    starts = [w[: STEMS[-1] + 1] for w in some if len(w) >= SHORTEST - 1]
    want = [not stems.isdisjoint({x[:n] for x in deletions(w, 1) for n in sizes}) for w in starts]
    assert Shared(stems).begin(starts, sizes).tolist() == want and any(want) and not all(want)
    assert not Shared([]).any_of(["abc"], 1).any()


def test_words_are_looked_up_together_as_alone():
    rng = random.Random(2)
    terms = [w for w in words(rng, 25, 4, 11)]
    stems = [w[:5] + "*" for w in words(rng, 6, 5, 9)]
    lexicon = Lexicon(terms + stems, terms)
    some = words(rng, 4000) + terms + [s[:-1] + "zz" for s in stems]
    for t in terms:
        at = rng.randrange(len(t))
        some += [t[:at] + t[at + 1 :], t[:at] + "x" + t[at:], t[:at] + "y" + t[at + 1 :]]
    alone = Lexicon(terms + stems, terms)
    want = [alone._find(w) for w in some]
    assert lexicon.kinds(some) == want and set(want) == {0, 1, 2}


def old_quoted(lexicon, text):
    """Every hit by its own window of the text."""
    from larkspar.llm.toxicity import QUOTES, REPORTING, WINDOW, WORD

    found = WORD.findall(text)
    spans = [m.span() for m in WORD.finditer(text)]
    hits = [i for i, k in enumerate(lexicon.kinds(found)) if k]
    out = set()
    for i in hits:
        first, last = max(0, i - WINDOW), min(len(found) - 1, i + WINDOW)
        marks = len(QUOTES.findall(text[spans[first][0] : spans[i][0]]))
        after = text[spans[i][1] : spans[last][1] + 2]
        if marks % 2 and QUOTES.search(after) or not REPORTING.isdisjoint(found[first:i]):
            out.add(i)
    return found, hits, out


def test_quoted_hits():
    rng = random.Random(3)
    lexicon = Lexicon(["badword"], ["badword"])
    seen = 0
    for _ in range(400):
        text = " ".join(rng.choices(["badword", "she", "said", '"', "„", "“well", "then", "quote", 'no"', "of", "all"], k=rng.randint(1, 40)))
        found, hits, want = old_quoted(lexicon, text)
        assert Lexicon._quoted(text, found, hits) == want
        seen += len(want)
    assert seen > 100


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    alphabet = list("abcdeé   \t\n,.'XYZ日09 　’“ß😀") + ["<|endoftext|>", " the", " harbour"]
    some = ["".join(rng.choices(alphabet, k=rng.randint(0, 200))) for _ in range(600)]
    return some + ["foo<|endoftext|> bar baz", "<|endoftext|>", "a <|endoftext|> b", "", " ", "  ", "word " * 3000, "x" * 4000, " a b c"]


@pytest.mark.parametrize("at_once", [2048, 30, 1 << 30])
@pytest.mark.parametrize("kind", ["plain", "A", "B"])
def test_joined_pieces_have_the_ids_of_whole_texts(texts, monkeypatch, kind, at_once):
    import sentencepiece
    from tokenizers import Tokenizer

    monkeypatch.setattr(token_output, "TEXT_BYTES", at_once)
    whole = Tokenizer.from_file(tokenizer_path())
    if kind == "B":
        model = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(PIECES))
        encoder, want = Pieces(tokenizer_path(PIECES)), [model.encode(t) if t else [] for t in texts]
    else:
        whole.encode_special_tokens = kind == "A"
        encoder = (BytePairs if kind == "A" else Encoder)(tokenizer_path())
        front = " " if kind == "A" else ""
        want = [whole.encode(front + t, add_special_tokens=False).ids if t else [] for t in texts]
    given = texts if kind == "plain" else [" " + t if t else "" for t in texts]
    for _ in range(2):  # new and remembered pieces
        for start in range(0, len(given), 250):
            ids, counts = encoder.encode(pa.array(given[start : start + 250], pa.large_string()))
            cuts = np.append(0, np.cumsum(counts))
            assert [ids[a:b].tolist() for a, b in zip(cuts, cuts[1:])] == want[start : start + 250]
