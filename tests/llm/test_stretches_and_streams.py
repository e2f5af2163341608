"""Texts of mixed scripts in the token counter, and the streaming search against all segmentations."""

import random

import ahocorasick
import public_tokenizers

from blotter.llm import sentencepiece_codec, textops, token_counts

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def test_foreign_stretches_and_special_strings_leave_the_rest_to_the_lookup():
    split = token_counts.Splitter(BYTE_BPE)
    for text in ("many plain words 😀 and more", "plain words <|endoftext|> and more", "plain words 漢字 and more"):
        pieces, n = split.pieces(text)
        assert n and {"plain", " plain"} & set(pieces) and " more" in pieces
    assert split.pieces("") == ([], 0)
    rng = random.Random(7)
    alphabet = list("ab'stlre 12 \n\t\x85\xa0 　᠎\x1c\x1féßЖ.,;!?—中漢😀ـ́​") + ["  ", "<|endoftext|>", "the", " 中文 words ", " 's", "'ll", "\r\n"]
    for _ in range(4000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40)))
        pieces, n = split.pieces(text)
        assert n + sum(map(split.length, pieces)) == split.whole(text)


def _unigram(scores):
    codec = sentencepiece_codec.Codec.__new__(sentencepiece_codec.Codec)
    codec.kind, codec.scores, codec.ids = "unigram", scores, {p: i for i, p in enumerate(scores)}
    codec.longest, codec.pairs = max(map(len, scores)), textops.Memo(10)
    codec.singles = {p for p in scores if len(p) == 1}
    codec.automaton = ahocorasick.Automaton()
    for p in scores:
        codec.automaton.add_word(p, p)
    codec.automaton.make_automaton()
    return codec


def test_streaming_search_finds_the_best_sum_over_many_commits():
    rng = random.Random(3)
    for _ in range(60):
        pieces = {"".join(rng.choice("abc") for _ in range(rng.randint(1, 4))) for _ in range(12)} | {"a", "b"}
        scores = {p: -float(rng.randint(1, 64)) for p in pieces}
        codec = _unigram(scores)
        text = "".join(rng.choice("abcz") for _ in range(rng.randint(0, 90)))
        best = [0.0]  # over all segmentations, from the whole text
        for end in range(1, len(text) + 1):
            arcs = [(best[end - k] + scores[text[end - k : end]]) for k in range(1, min(end, 4) + 1) if text[end - k : end] in scores]
            if text[end - 1] not in scores:
                arcs.append(best[end - 1] - 1e6)
            best.append(max(arcs))
        got = list(codec.pieces(text))
        assert "".join(got) == text and sum(scores.get(p, -1e6) for p in got) == best[-1]


def test_pieces_are_committed_before_the_text_ends():
    codec = _unigram({"a": -1.0, "b": -1.0, "ab": -1.5})
    looked = []

    class Watched:
        def iter(self, text):
            for at, piece in real.iter(text):
                looked.append(at)
                yield at, piece

        def __len__(self):
            return len(real)

    real, codec.automaton = codec.automaton, Watched()
    assert next(codec.pieces("ab" * 500)) == "ab" and max(looked) < 20
