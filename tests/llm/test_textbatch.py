import weakref

import numpy as np

from tessera.llm import textbatch


def test_a_task_gives_memory_back_when_all_it_held_is_gone(monkeypatch):
    held, seen = [], []

    def run(batches):
        big = np.zeros(1000)
        held.append(weakref.ref(big))
        for b in batches:
            yield b + big.size
    monkeypatch.setattr(textbatch, "release", lambda: seen.append([r() is None for r in held]))
    assert list(textbatch.lean(run)([1, 2])) == [1001, 1002]
    assert seen == [[], [True]]  # before it began, and after its array went

    held.clear(), seen.clear()
    task = textbatch.lean(run)([1, 2])
    next(task)
    task.close()  # a reader that stops early
    assert len(seen) == 2


def test_what_an_operator_holds_goes_when_another_one_begins(monkeypatch):
    monkeypatch.setattr(textbatch, "_HELD", {})
    made = []

    def encoder(batches):
        for b in batches:
            yield textbatch.held("encoder", lambda: made.append(b) or np.zeros(1000)).size + b
    own = textbatch.lean(encoder, "encoder")
    assert list(own([1, 2])) == [1001, 1002] and list(own([3])) == [1003]
    assert made == [1]  # kept for the next task of its kind
    gone = weakref.ref(textbatch._HELD["encoder"])
    assert list(textbatch.lean(lambda batches: batches)([5])) == [5]
    assert gone() is None and list(own([6])) == [1006] and made == [1, 6]
