"""Numpy kernels: Simple-8b coding, the recurrent model's gradients."""

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from lotwise.llm import gru, simple8b


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.just(0), st.integers(0, 60000), st.integers(0, 2**64 - 1)), max_size=3000), st.data())
def test_simple8b_round_trip(ids, data):
    ids = np.array(ids, np.uint64)
    segment = simple8b.encode(np.array([len(ids)]), ids)
    lengths, back = simple8b.decode(segment)
    assert lengths.tolist() == [len(ids)] and (back == ids).all()
    a, b = sorted((data.draw(st.integers(0, len(ids))), data.draw(st.integers(0, len(ids)))))
    assert (simple8b.decode_range(segment, a, b) == ids[a:b]).all()


def test_simple8b_packs_many_small_ids():
    assert len(simple8b.pack(np.zeros(1024, np.uint64))[0]) < 12
    assert len(simple8b.pack(np.full(1024, 2**63, np.uint64))[0]) == 2048


def test_gradients(monkeypatch):
    monkeypatch.setattr(gru, "_F", np.float64)
    draw = np.random.default_rng(0)
    w = {k: v.astype(float) for k, v in gru.initial(np.arange(gru.FREQUENT, 0, -1) * 10.0, 3_000_000).items()}
    docs = [draw.integers(0, gru.REST + 1, n).astype(np.int32) for n in (5, 9, 3, 12, 1)]
    (_, inputs, targets, fresh), = gru._windows(docs, 2)
    start, real = np.zeros((inputs.shape[1], gru.STATE)), targets >= 0

    def total():
        return gru._outputs(w, gru._forward(w, inputs, fresh, start)[0][real], targets[real], False)[0].sum()

    states, kept = gru._forward(w, inputs, fresh, start)
    _, grads, pull = gru._outputs(w, states[real], targets[real], True)
    whole = np.zeros_like(states)
    whole[real] = pull
    grads |= gru._backward(w, inputs, fresh, kept, whole)
    for key, g in grads.items():
        flat, values = g.ravel(), w[key].ravel()
        for j in np.argsort(-np.abs(flat))[:3]:
            old = values[j]
            values[j] = old + 1e-5
            up = total()
            values[j] = old - 1e-5
            down = total()
            values[j] = old
            assert abs((up - down) / 2e-5 - flat[j]) < 1e-4


def test_state_is_carried_over_windows():
    docs = [np.arange(100, dtype=np.int32) % 7, np.arange(40, dtype=np.int32) % 5]
    w = gru.initial(np.ones(gru.FREQUENT), 2000)
    together = gru.log_probabilities(w, docs)
    alone = [gru.log_probabilities(w, [d])[0] for d in docs]
    assert np.allclose(together, alone, rtol=1e-5)


def test_every_group_of_other_words_learns():
    """Rarer words are more than one number: a model of two groups learns which of them follows which word."""
    w = gru.initial(np.full(gru.FREQUENT, 10.0), 0, np.full(70, 10.0))
    assert np.isclose(np.exp(gru._outputs(w, np.zeros((70, gru.STATE), np.float32), gru.REST + np.arange(70), False)[0]).sum(), 700 / 10940, rtol=1e-3)
    docs = [np.array([1, gru.REST, 2, gru.REST + 69] * 20, np.int32)] * 60
    trainer = gru.Trainer(w, 0.02)
    for _ in range(200):
        trainer.learn(docs)
    swapped = np.array([1, gru.REST + 69, 2, gru.REST] * 20, np.int32)
    right, wrong = gru.log_probabilities(trainer.w, [docs[0], swapped])
    assert right > wrong + 40


def _plain_forward(w, inputs, fresh, state):
    """The recurrence as it is written down, a row per lane."""
    size, states = gru.STATE, []
    for t in range(len(inputs)):
        state = state * fresh[t][:, None]
        drive, pull = w["input"][inputs[t]], state @ w["state"]
        gates = 1 / (1 + np.exp(-(drive[:, :2 * size] + pull[:, :2 * size])))
        z, r = gates[:, :size], gates[:, size:]
        new = np.tanh(drive[:, 2 * size:] + r * pull[:, 2 * size:])
        state = new + z * (state - new)
        states.append(state)
    return np.array(states)


def _plain_outputs(w, states, targets):
    """Log-probability of each target from whole softmaxes."""
    logits = states @ w["to_class"] + w["class_bias"]
    logs = logits - np.log(np.exp(logits).sum(1, keepdims=True))
    group, member, each = targets // gru.MEMBERS, targets % gru.MEMBERS, np.arange(len(targets))
    inner = np.einsum("ns,nsm->nm", states, w["to_word"][group]) + w["word_bias"][group]
    return logs[each, group] + inner[each, member] - np.log(np.exp(inner).sum(1))


def test_states_and_probabilities_equal_the_plain_form():
    draw = np.random.default_rng(2)
    w = gru.initial(np.arange(gru.FREQUENT, 0, -1) * 10.0, 9_000_000, np.full(700, 2000.0))
    w["state"] *= 5
    docs = [draw.integers(0, gru.REST + 700, 64).astype(np.int32) for _ in range(gru.LANES)]
    _, inputs, targets, fresh = next(gru._windows(docs))
    start = draw.normal(0, 0.3, (inputs.shape[1], gru.STATE)).astype(np.float32)
    states, kept = gru._forward(w, inputs, fresh, start)
    plain = _plain_forward(w, inputs, fresh, start)
    assert states.shape == plain.shape and np.allclose(states, plain, atol=1e-5)
    rows = states.reshape(-1, gru.STATE)
    assert np.allclose(gru._outputs(w, rows, targets.ravel(), True)[0], _plain_outputs(w, rows, targets.ravel()), atol=1e-4)
    # What a step computes with runs over all lanes at once, not in pieces of STATE numbers.
    assert all(x.flags.c_contiguous and x.shape[1] == inputs.shape[1] for step in kept for x in step)
