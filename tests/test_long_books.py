"""Books whose texts are too long to be held at once."""

import hashlib
import json

import numpy as np
import pytest

from inkmill.plans import model_slicing as M
from inkmill.plans.config import SliceOptions
from inkmill.plans.prompts import messages
from inkmill.plans.queries import _proposals
from inkmill.providers.base import ScriptedProvider


def sliced(options, clients, n=400, batch=30, read=None):
    texts = [f"line {i} é" * (i % 5 + 1) for i in range(n)]

    def batches():
        for a in range(0, n, batch):
            if read is not None:
                read.append(a)
            yield texts[a : a + batch], np.array([len(t.replace(" ", "")) for t in texts[a : a + batch]]), np.array([len(t) for t in texts[a : a + batch]])

    return texts, list(M.slice_lines(batches(), options, clients))


@pytest.mark.parametrize("budget", [500, 10**9])
def test_texts_in_a_file_change_nothing(monkeypatch, budget):
    options = SliceOptions(provider_order=("p",), target_chars_min=100, target_chars_max=200, chunk_input_tokens=budget)
    seen, kinds = [], set()

    def answer(prompt):
        kinds.add(type(prompt[-1]["content"]).__name__)
        seen.append(str(prompt[-1]["content"]))
        return _proposals(prompt)

    clients = {"p": (ScriptedProvider(answer), "m")}
    texts, want = sliced(options, clients)
    prompts = list(seen)
    monkeypatch.setattr(M, "IN_MEMORY", 100)
    seen.clear()
    assert sliced(options, clients)[1] == want and seen == prompts and kinds == {"str", "LongText"}
    assert "\n".join(s.text for s in want) == "\n".join(texts) and want[-1].end_line == 400


def test_a_book_is_read_only_as_far_as_it_is_asked_about():
    read = []
    clients = {"p": (ScriptedProvider(lambda _: "junk"), "m")}
    _, found = sliced(SliceOptions(provider_order=("p",), retry_max=1, chunk_input_tokens=100), clients, read=read)
    assert read == [0] and found[0].error


def test_keys_of_answers_stay():
    prompt = messages(3, [(3, 'a "b" \\ é\n')], 1, 2)
    assert M._key("p", "m", prompt) == hashlib.sha256(json.dumps(["p", "m", prompt], ensure_ascii=False).encode()).hexdigest()
    assert M._key("p", "m", []) == hashlib.sha256(b'["p", "m", []]').hexdigest()
