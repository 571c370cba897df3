"""A gated recurrent language model in numpy: class-factored softmax, truncated backpropagation, carried state.

Frequent words have a number, by frequency; numbers from ``REST`` on stand for groups of rarer words, in which a word's
share comes from its count. ``MEMBERS`` neighbouring numbers form a class, so every word has an input vector and a
probability that depends on the state. Documents are dealt to lanes that run side by side; a lane's state
is set to zero where a document begins and is carried over all windows of the document.
"""

from __future__ import annotations

import heapq

import numpy as np

CLASSES, MEMBERS = 16, 64
FREQUENT = CLASSES * MEMBERS
REST, START = FREQUENT, -1   # number of the first group of other words; input number of nothing before
STATE, LANES, WINDOW = 8, 256, 32
NEVER = -1e9   # bias of numbers behind the last group
_F = np.float32


def initial(counts: np.ndarray, total: int, rest: np.ndarray | None = None, seed: int = 3) -> dict[str, np.ndarray]:
    """Small random weights; the biases start from the frequencies ``counts`` of the frequent words and ``rest`` of the
    groups of others, by default a single one."""
    rest = np.array([max(total - counts.sum(), 0)]) if rest is None else rest
    classes_of_rest = -(-len(rest) // MEMBERS)
    draw = np.random.default_rng(seed)
    small = lambda *shape: draw.normal(0, 0.1, shape).astype(_F)
    held = np.zeros((CLASSES + classes_of_rest) * MEMBERS)
    held[:len(counts)] = counts
    held[REST:REST + len(rest)] = rest
    by_class = held.reshape(-1, MEMBERS)
    classes = by_class.sum(1) + 0.5
    words = by_class + 1e-3
    words.ravel()[REST + len(rest):] = 0
    with np.errstate(divide="ignore"):
        bias = np.maximum(np.log(words / words.sum(1, keepdims=True)), NEVER)
    w = {"input": small(len(held) + 1, 3 * STATE), "state": small(STATE, 3 * STATE), "to_class": small(STATE, len(by_class)),
         "class_bias": np.log(classes / classes.sum()).astype(_F), "to_word": small(len(by_class), STATE, MEMBERS),
         "word_bias": bias.astype(_F)}
    # The groups of other words start as one and grow apart as they are learned.
    w["input"][REST:-1], w["to_class"][:, CLASSES:], w["to_word"][CLASSES:] = w["input"][REST], w["to_class"][:, CLASSES:CLASSES + 1], 0
    return w


def smoothed(weights: dict[str, np.ndarray], before: np.ndarray, after: np.ndarray) -> dict[str, np.ndarray]:
    """Weights whose biases follow the counts ``after`` of the groups of other words in place of ``before``."""
    if not before.sum():
        return weights
    x, y = (np.append(v, np.zeros(-len(v) % MEMBERS)).reshape(-1, MEMBERS) for v in (before, after))
    w = {k: v.copy() for k, v in weights.items()}
    w["class_bias"][CLASSES:] += np.log(y.sum(1) / x.sum(1))
    w["word_bias"][CLASSES:][x > 0] += np.log(y[x > 0] / x[x > 0])
    return w


def flat(weights: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([weights[k].ravel() for k in sorted(weights)])


def shaped(values: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k in sorted(like):
        out[k] = values[at:at + like[k].size].reshape(like[k].shape).astype(_F)
        at += like[k].size
    return out


def lanes(lengths: np.ndarray, most: int = LANES) -> list[list[int]]:
    """Documents of each lane: the longest first, each to the lane that is shortest so far."""
    count = max(1, min(most, len(lengths), -(-int(lengths.sum()) // max(1, int(lengths.max(initial=1))))))
    heap, out = [(0, k) for k in range(count)], [[] for _ in range(count)]
    for d in np.argsort(-lengths, kind="stable").tolist():
        size, k = heapq.heappop(heap)
        out[k].append(d)
        heapq.heappush(heap, (size + int(lengths[d]), k))
    return out


def _raised(weights: np.ndarray, bias: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(matrices whose last row is the bias, whether the largest logit of a row has to be sought) for each of several layers.

    Biases are moved so that exponentials of logits neither overflow nor vanish: states lie between -1 and 1, which bounds all
    logits at once; the largest of each row is only sought if that bound is wide.
    """
    reach = np.abs(weights).sum(1).max(1)
    moved = bias - (bias.max(1) + reach)[:, None]
    return np.concatenate([weights, moved[:, None, :]], 1), reach > 30


def _softmax(held: np.ndarray, layer: np.ndarray, wide: bool, chosen: np.ndarray, back: bool):
    """Log-probability of the chosen place of each row of ``held`` (states and a one); on request the gradients of their sum
    by ``layer`` and by the states."""
    x = held @ layer
    if wide:
        x -= x.max(1, keepdims=True)
    flat, place = x.reshape(-1), np.arange(0, x.size, x.shape[1]) + chosen
    out = flat.take(place)
    np.exp(x, out=x)
    total = x @ np.ones(x.shape[1], x.dtype)
    if not back:
        return out - np.log(total), None, None
    # The gradient by a row's logits is its exponentials, less the total at the chosen one, over the total with a minus;
    # the division is left to the few columns beside the logits.
    flat[place] -= total
    each = (-1 / total)[:, None]
    return out - np.log(total), (held * each).T @ x, (x @ layer[:-1].T) * each


def _forward(w, inputs, fresh, state):
    """States after each step of a window; what the way back needs, with the lanes in the last axis."""
    steps, state = len(inputs), np.ascontiguousarray(state.T)
    kept = []
    states = np.empty((steps, *state.shape), _F)
    drive = np.ascontiguousarray(w["input"].take(inputs, 0).transpose(0, 2, 1))
    turn = np.ascontiguousarray(w["state"].T)
    for t in range(steps):
        state = state * fresh[t]
        pull = turn @ state
        gates = 1 / (1 + np.exp(-(drive[t, :2 * STATE] + pull[:2 * STATE])))
        z, r = gates[:STATE], gates[STATE:]
        new = np.tanh(drive[t, 2 * STATE:] + r * pull[2 * STATE:])
        kept.append((state, pull, z, r, new))
        state = new + z * (state - new)
        states[t] = state
    return np.ascontiguousarray(states.transpose(0, 2, 1)), kept


def _by_number(numbers: np.ndarray) -> np.ndarray:
    """Order that brings equal numbers together; sixteen bits hold them all and are sorted by radix."""
    return np.argsort(numbers.astype(np.uint16), kind="stable")


def _outputs(w, states, targets, back: bool):
    """Log-probability of each target number; on request the gradients of their sum."""
    order = _by_number(targets // MEMBERS)
    group, member = targets[order] // MEMBERS, targets[order] % MEMBERS
    held = np.concatenate([states.take(order, 0), np.ones((len(states), 1), states.dtype)], 1)   # the one meets the bias
    layer, wide = _raised(w["to_class"][None], w["class_bias"][None])
    logs, both, pulls = _softmax(held, layer[0], wide[0], group, back)
    logs = logs.astype(np.float64)
    grads, pull = {}, None
    if back:
        grads = {"to_class": both[:-1], "class_bias": both[-1], "to_word": np.zeros_like(w["to_word"]), "word_bias": np.zeros_like(w["word_bias"])}
    layers, wide = _raised(w["to_word"], w["word_bias"])
    ends = np.searchsorted(group, np.arange(len(layers) + 1))
    for c in np.flatnonzero(np.diff(ends)).tolist():
        mine = slice(ends[c], ends[c + 1])
        more, both, pulled = _softmax(held[mine], layers[c], wide[c], member[mine], back)
        logs[mine] += more
        if back:
            grads["to_word"][c], grads["word_bias"][c] = both[:-1], both[-1]
            pulls[mine] += pulled
    out = np.empty_like(logs)
    out[order] = logs
    if back:
        back_again = np.empty_like(order)
        back_again[order] = np.arange(len(order))
        pull = pulls.take(back_again, 0)
    return out, grads, pull


def _backward(w, inputs, fresh, kept, pull):
    """Gradients of the recurrent part from those of the window's states; what lies before the window is fixed."""
    grads = {"input": np.zeros_like(w["input"])}
    steps, count = inputs.shape
    pull = np.ascontiguousarray(pull.transpose(0, 2, 1))
    drives = np.empty((steps, 3 * STATE, count), _F)
    through = np.empty((3 * STATE, steps, count), _F)
    carried = np.zeros_like(pull[0])
    for t in range(steps - 1, -1, -1):
        state, pulled, z, r, new = kept[t]
        d = pull[t] + carried
        rest = d * (1 - z)
        dn = rest * (1 - new * new)
        dz = rest * (state - new) * z
        dnr = dn * r
        dr = dnr * pulled[2 * STATE:] * (1 - r)
        drives[t, :STATE], drives[t, STATE:2 * STATE], drives[t, 2 * STATE:] = dz, dr, dn
        back = np.concatenate([dz, dr, dnr])
        through[:, t] = back
        carried = (d * z + w["state"] @ back) * fresh[t]
    before = np.concatenate([k[0] for k in kept], 1)
    grads["state"] = before @ through.reshape(3 * STATE, -1).T
    order = _by_number(inputs.ravel())
    numbers = inputs.ravel()[order]
    begin = np.flatnonzero(np.append(True, numbers[1:] != numbers[:-1]))
    rows = np.ascontiguousarray(drives.transpose(0, 2, 1)).reshape(-1, 3 * STATE)
    grads["input"][numbers[begin]] = np.add.reduceat(rows.take(order, 0), begin, axis=0)
    return grads


def _windows(docs: list[np.ndarray], most: int = LANES):
    """(document of each place or -1, inputs, targets, fresh) over all windows; documents are word numbers with their end."""
    lengths = np.array([len(d) for d in docs])
    dealt = lanes(lengths, most)
    size = max(int(lengths[lane].sum()) for lane in dealt)
    targets = np.full((len(dealt), size), -1, np.int32)
    inputs = np.full((len(dealt), size), START, np.int32)
    owner = np.full((len(dealt), size), -1, np.int32)
    fresh = np.ones((len(dealt), size), _F)
    for k, lane in enumerate(dealt):
        at = 0
        for d in lane:
            n = len(docs[d])
            targets[k, at:at + n], owner[k, at:at + n] = docs[d], d
            inputs[k, at + 1:at + n] = docs[d][:-1]
            fresh[k, at] = 0
            at += n
    for t in range(0, size, WINDOW):
        cut = slice(t, t + WINDOW)
        yield owner[:, cut].T, np.ascontiguousarray(inputs[:, cut].T), targets[:, cut].T, np.ascontiguousarray(fresh[:, cut].T)


def log_probabilities(w: dict[str, np.ndarray], docs: list[np.ndarray]) -> np.ndarray:
    """Natural log-probability of each document's numbers."""
    out, state = np.zeros(len(docs)), None
    for owner, inputs, targets, fresh in _windows(docs) if docs else ():
        state = np.zeros((inputs.shape[1], STATE), _F) if state is None else state
        states, _ = _forward(w, inputs, fresh, state)
        state = states[-1]
        real = targets >= 0
        logs, _, _ = _outputs(w, states[real], targets[real], False)
        out += np.bincount(owner[real], logs, minlength=len(docs))
    return out


class Trainer:
    """Adam over windows of truncated backpropagation."""

    def __init__(self, weights: dict[str, np.ndarray], rate: float):
        self.w = {k: v.copy() for k, v in weights.items()}
        self.rate, self.step, self.tokens = rate, 0, 0
        self._m = {k: np.zeros_like(v) for k, v in weights.items()}
        self._v = {k: np.zeros_like(v) for k, v in weights.items()}
        self._spare = {k: np.empty_like(v) for k, v in weights.items()}

    def learn(self, docs: list[np.ndarray]) -> None:
        state = None
        for _, inputs, targets, fresh in _windows(docs) if docs else ():
            state = np.zeros((inputs.shape[1], STATE), _F) if state is None else state
            states, kept = _forward(self.w, inputs, fresh, state)
            state = states[-1]
            real = targets >= 0
            n = int(real.sum())
            if not n:
                continue
            _, grads, pull = _outputs(self.w, states[real], targets[real], True)
            whole = np.zeros_like(states)
            whole[real] = pull
            grads |= _backward(self.w, inputs, fresh, kept, whole)
            self.step += 1
            self.tokens += n
            for k, g in grads.items():
                m, v, step = self._m[k], self._v[k], self._spare[k]
                g /= n
                np.subtract(g, m, out=step)
                step *= 0.1
                m += step
                np.multiply(g, g, out=g)
                g -= v
                g *= 0.005
                v += g
                np.divide(v, 1 - 0.995 ** self.step, out=g)
                np.sqrt(g, out=g)
                g += 1e-6
                np.divide(m, g, out=g)
                g *= self.rate / (1 - 0.9 ** self.step)
                self.w[k] += g
