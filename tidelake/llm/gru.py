"""A gated recurrent network with a class-factored softmax, in numpy: forward, truncated backpropagation, Adam.

The state gives the class of the next word and, inside the class, which of its commonest words it is
or that it is another one: P(class | state) P(slot | class, state).
"""

from __future__ import annotations

import numpy as np

HIDDEN, LANES, STEPS = 24, 256, 16
#: Logit of a slot that no word has.
NEVER = -30.0

Weights = dict[str, np.ndarray]


def initial(
    classes: int, log_share: np.ndarray, hidden: int = HIDDEN, seed: int = 3, slot_share: np.ndarray | None = None
) -> Weights:
    """Small random weights; the outputs start at the shares of classes and, within them, of slots.

    Input number ``classes`` starts a document.  ``slot_share`` is classes x slots in logarithms; without
    it the network tells classes only.
    """
    random = np.random.default_rng(seed)
    scale = 1 / np.sqrt(hidden)
    weights = {
        "embed": random.normal(0, 0.3, (classes + 1, 3 * hidden)).astype(np.float32),
        "recur": random.normal(0, scale, (hidden, 3 * hidden)).astype(np.float32),
        "out": random.normal(0, 0.05, (hidden, classes)).astype(np.float32),
        "bias": log_share.astype(np.float32),
    }
    if slot_share is not None:
        weights["word"] = random.normal(0, 0.05, (classes, hidden, slot_share.shape[1])).astype(np.float32)
        weights["word_bias"] = slot_share.astype(np.float32)
    return weights


#: A logit beyond the range of exp counts as its end.
HIGHEST = 80


def _joined(weights: Weights) -> Weights:
    """The weights with each bias as a last row of its matrix: states have a last row of ones, so no bias is added by itself."""
    joined = {name: weights[name] for name in ("embed", "recur")}
    joined["out"] = np.vstack([weights["out"], weights["bias"][None]])
    if "word" in weights:
        joined["word"] = np.concatenate([weights["word"], weights["word_bias"][:, None]], axis=1)
    return joined


def _parted(joined: Weights) -> Weights:
    """The inverse of ``_joined``."""
    weights = {"embed": joined["embed"], "recur": joined["recur"], "out": joined["out"][:-1], "bias": joined["out"][-1]}
    if "word" in joined:
        weights |= {"word": joined["word"][:, :-1], "word_bias": joined["word"][:, -1]}
    return {name: np.ascontiguousarray(w) for name, w in weights.items()}


def _run(joined: Weights, inputs: np.ndarray, fresh: np.ndarray, state: np.ndarray, keep: bool = True):
    """(states, kept): the state of every lane after each step and, if asked for, what backpropagation needs of the steps.

    Arrays are hidden x steps x lanes, so that what is added up lies apart and what is done alike lies
    together; ``states`` has one more row, of ones.  ``state`` is hidden x lanes.
    """
    hidden, (steps, lanes) = len(state), inputs.shape
    kind = joined["embed"].dtype
    # 1 / (1 + exp(-x)) and 2 / (1 + exp(-2 x)) - 1, which is tanh: the factors go into the weights.
    factor = np.repeat(np.array([-1, -2], kind), [2 * hidden, hidden])[:, None]
    recur = joined["recur"].T * factor
    x = np.take(joined["embed"].T * factor, inputs, axis=1)
    states = np.ones((hidden + 1, steps, lanes), kind)
    before, gates, un, n = kept = [np.empty((rows, steps if keep else 1, lanes), kind) for rows in (hidden, 2 * hidden, hidden, hidden)]
    u, y = np.empty((3 * hidden, lanes), kind), np.empty((hidden, lanes), kind)
    forgets = fresh.any(axis=1)
    with np.errstate(over="ignore"):
        for t in range(steps):
            at = t if keep else 0
            before[:, at] = state
            if forgets[t]:
                before[:, at, fresh[t]] = 0
            np.matmul(recur, before[:, at], out=u)
            zr = np.add(x[: 2 * hidden, t], u[: 2 * hidden], out=u[: 2 * hidden])
            np.exp(zr, out=zr)
            zr += 1
            np.divide(1, zr, out=zr)
            if keep:
                gates[:, t], un[:, t] = zr, u[2 * hidden :]
            np.multiply(zr[hidden:], u[2 * hidden :], out=y)
            y += x[2 * hidden :, t]
            np.exp(y, out=y)
            y += 1
            np.divide(2, y, out=y)
            y -= 1
            if keep:
                n[:, t] = y
            state = np.subtract(before[:, at], y, out=states[:hidden, t])
            state *= zr[:hidden]
            state += y
    return states, kept


def _softmax(logits: np.ndarray, at: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(sums, log probabilities at the given places) of columns of logits, by one pass of exp; leaves exp in the logits."""
    np.minimum(logits, logits.dtype.type(HIGHEST), out=logits)
    chosen = logits[at]
    np.exp(logits, out=logits)
    total = logits.sum(axis=0)
    return total, chosen - np.log(total)


def _by_class(targets: np.ndarray, classes: int) -> tuple[np.ndarray, list[tuple[int, slice]]]:
    """(order, [(class, its part of the order)]) of the classes among the targets."""
    order = np.argsort(targets.astype(np.int16) if classes < 1 << 15 else targets, kind="stable")
    cuts = np.cumsum(np.bincount(targets, minlength=classes)).tolist()
    return order, [(c, slice(a, b)) for c, (a, b) in enumerate(zip([0, *cuts], cuts, strict=False)) if b > a]


def _slot_logits(words: np.ndarray, held: np.ndarray, parts: list[tuple[int, slice]]) -> np.ndarray:
    """Logits of the slots of each token's class: slots x tokens, of states in the order of their classes."""
    logits = np.empty((words.shape[2], held.shape[1]), held.dtype)
    for c, mine in parts:
        np.matmul(words[c].T, held[:, mine], out=logits[:, mine])
    return logits


def _gradients(joined: Weights, inputs, targets, fresh, live, state, slots, grads: Weights) -> tuple[float, np.ndarray]:
    """(loss, last state) of a window, all hidden x lanes; the gradients go to ``grads``."""
    hidden, (steps, lanes) = len(state), inputs.shape
    states, (before, gates, un, n) = _run(joined, inputs, fresh, state)
    there = np.flatnonzero(live)
    count = max(len(there), 1)
    kind = targets.reshape(-1)[there]
    parts = []
    if slots is not None:
        order, parts = _by_class(kind, joined["out"].shape[1])
        there, kind = there[order], kind[order]
    held = np.take(states.reshape(hidden + 1, -1), there, axis=1)
    scale = held.dtype.type(1 / count)
    at = kind, np.arange(len(kind))
    flat = joined["out"].T @ held
    total, logs = _softmax(flat, at)
    loss = -float(logs.sum()) / count
    flat *= scale / total
    flat[at] -= scale
    np.matmul(held, flat.T, out=grads["out"])
    slopes = joined["out"][:-1] @ flat
    if slots is not None:
        at = slots.reshape(-1)[there], at[1]
        flat = _slot_logits(joined["word"], held, parts)
        total, logs = _softmax(flat, at)
        loss -= float(logs.sum()) / count
        flat *= scale / total
        flat[at] -= scale
        grads["word"][...] = 0
        own = np.empty_like(slopes)
        for c, mine in parts:
            np.matmul(held[:, mine], flat[:, mine].T, out=grads["word"][c])
            np.matmul(joined["word"][c, :-1], flat[:, mine], out=own[:, mine])
        slopes += own
    # Taking is faster than putting: the last column is that of places that don't count.
    place = np.full(steps * lanes, len(there))
    place[there] = np.arange(len(there))
    below = np.take(np.hstack([slopes, np.zeros((hidden, 1), held.dtype)]), place, axis=1).reshape(hidden, steps, lanes)
    z, r = gates[:hidden], gates[hidden:]
    to_n, to_z, to_r = (1 - z) * (1 - n * n), (before - n) * (z * (1 - z)), un * (r * (1 - r))
    to_r *= held.dtype.type(-0.5)  # ``un`` has its factor of -2 still
    # Slopes on n, on the gates and on what r multiplies: the first three are those of the inputs, the last three those of the recurrence.
    du = np.empty((4 * hidden, steps, lanes), held.dtype)
    carried = np.zeros((hidden, lanes), held.dtype)
    forgets = fresh.any(axis=1)
    for t in range(steps - 1, -1, -1):
        carried += below[:, t]
        dn = np.multiply(carried, to_n[:, t], out=du[:hidden, t])
        np.multiply(carried, to_z[:, t], out=du[hidden : 2 * hidden, t])
        np.multiply(dn, to_r[:, t], out=du[2 * hidden : 3 * hidden, t])
        np.multiply(dn, r[:, t], out=du[3 * hidden :, t])
        carried *= z[:, t]
        carried += joined["recur"] @ du[hidden:, t]
        if forgets[t]:
            carried[:, fresh[t]] = 0
    du = du.reshape(4 * hidden, -1)
    np.matmul(before.reshape(hidden, -1), du[hidden:].T, out=grads["recur"])
    given = np.zeros((len(grads["embed"]), inputs.size), du.dtype)
    given[inputs.reshape(-1), np.arange(inputs.size)] = 1
    moved = given @ du[: 3 * hidden].T
    grads["embed"][:, : 2 * hidden], grads["embed"][:, 2 * hidden :] = moved[:, hidden:], moved[:, :hidden]
    return loss, states[:hidden, -1]


def gradients(
    weights: Weights, inputs: np.ndarray, targets: np.ndarray, fresh: np.ndarray, live: np.ndarray, state: np.ndarray,
    slots: np.ndarray | None = None,
):
    """(loss, gradients, last state) of one window of steps x lanes.

    ``fresh`` marks steps that start a document and forget the state, ``live`` those that count.
    Gradients stop at the window's start (truncated backpropagation); the state goes on.
    """
    joined = _joined(weights)
    grads = {name: np.zeros_like(w) for name, w in joined.items()}
    loss, last = _gradients(joined, inputs, targets, fresh, live, state.T, slots, grads)
    return loss, _parted(grads), last.T


def lanes_of(lengths: np.ndarray, lanes: int) -> list[list[int]]:
    """Sequences dealt to lanes of even length: the longest first, each to the shortest lane."""
    import heapq

    heap = [(0, lane) for lane in range(min(lanes, len(lengths)))]
    dealt: list[list[int]] = [[] for _ in heap]
    for i in np.argsort(-lengths, kind="stable"):
        total, lane = heapq.heappop(heap)
        dealt[lane].append(int(i))
        heapq.heappush(heap, (total + int(lengths[i]), lane))
    return dealt


def laid_out(classes: np.ndarray, offsets: np.ndarray, start: int, lanes: int):
    """(inputs, targets, fresh, place): documents one after another on lanes, longest lane first.

    Arrays are steps x lanes; ``place`` is the token's position in ``classes``, -1 beyond a lane's end.
    """
    dealt = lanes_of(np.diff(offsets), lanes)
    dealt.sort(key=lambda docs: -sum(int(offsets[d + 1] - offsets[d]) for d in docs))
    columns = [np.concatenate([np.arange(offsets[d], offsets[d + 1]) for d in docs]) for docs in dealt]
    place = np.full((max(map(len, columns), default=0), len(columns)), -1, np.int64)
    for lane, column in enumerate(columns):
        place[: len(column), lane] = column
    first = np.zeros(len(classes) + 1, bool)
    first[offsets[:-1]] = True
    fresh = first[place]
    fresh[place < 0] = False
    inputs = np.where(fresh, start, classes[np.maximum(place - 1, 0)])
    return inputs, classes[np.maximum(place, 0)], fresh, place


def train(
    weights: Weights, classes: np.ndarray, offsets: np.ndarray, rate: float = 0.01, steps: int = STEPS, lanes: int = LANES,
    slots: np.ndarray | None = None,
) -> Weights:
    """One pass over the documents, window by window; the state goes from window to window.

    Lanes that have ended are dropped, and a window moves the weights by its share of live tokens: otherwise
    the last windows, where the longest document is alone, would count as much as full ones.
    """
    start = len(weights["bias"])
    inputs, targets, fresh, place = laid_out(classes, offsets, start, lanes)
    moved = _joined(weights)
    if slots is None:
        moved.pop("word", None)
    # All weights lie in one array, so that a window moves them at once.
    flat = np.concatenate([w.ravel() for w in moved.values()]).astype(np.float32)
    slopes, mean, square, pace_of = (np.zeros_like(flat) for _ in range(4))
    cuts = np.cumsum([0, *(w.size for w in moved.values())])
    joined, grads = (
        {name: whole[a:b].reshape(w.shape) for (name, w), a, b in zip(moved.items(), cuts[:-1], cuts[1:], strict=True)} for whole in (flat, slopes)
    )
    state = np.zeros((weights["recur"].shape[0], inputs.shape[1]), np.float32)
    full = steps * inputs.shape[1]
    for turn, at in enumerate(range(0, len(inputs), steps), 1):
        # Lanes are in order of falling length: the live ones come first.
        part = slice(at, at + steps), slice(0, int((place[at] >= 0).sum()))
        live = place[part] >= 0
        chosen = None if slots is None else slots[np.maximum(place[part], 0)]
        _, state = _gradients(joined, inputs[part], targets[part], fresh[part], live, state[:, : part[1].stop], chosen, grads)
        share = np.float32(live.sum() / full)
        pace = np.float32(rate * share * np.sqrt(1 - 0.99**turn) / (1 - 0.9**turn))
        np.clip(slopes, -1, 1, out=slopes)
        slopes *= share
        mean *= np.float32(0.9)
        mean += np.multiply(slopes, np.float32(0.1), out=pace_of)
        square *= np.float32(0.99)
        slopes *= slopes
        slopes *= np.float32(0.01)
        square += slopes
        np.sqrt(square, out=pace_of)
        pace_of += np.float32(1e-6)
        np.divide(mean, pace_of, out=pace_of)
        pace_of *= pace
        flat -= pace_of
    return {name: w.copy() for name, w in weights.items()} | _parted(joined)


def score(
    weights: Weights, classes: np.ndarray, offsets: np.ndarray, lanes: int = 512, steps: int = 16, slots: np.ndarray | None = None
) -> np.ndarray:
    """Natural log probability of every token's class, and of its slot if told, given all tokens before it in its document."""
    out = np.zeros(len(classes))
    if not len(classes):
        return out
    # The longest document is a lane by itself; more lanes than fill up beside it would end early.
    lanes = min(lanes, -(-len(classes) // int(np.diff(offsets).max())))
    inputs, targets, fresh, place = laid_out(classes, offsets, len(weights["bias"]), lanes)
    joined = _joined(weights)
    hidden = weights["recur"].shape[0]
    state = np.zeros((hidden, inputs.shape[1]), np.float32)
    for at in range(0, len(inputs), steps):
        # Lanes are in order of falling length: the live ones come first.
        part = slice(at, at + steps), slice(0, int((place[at] >= 0).sum()))
        states, _ = _run(joined, inputs[part], fresh[part], state[:, : part[1].stop], keep=False)
        state = states[:hidden, -1]
        there = np.flatnonzero(place[part] >= 0)
        token, kind = place[part].reshape(-1)[there], targets[part].reshape(-1)[there]
        if slots is not None:
            order, parts = _by_class(kind, len(weights["bias"]))
            there, token, kind = there[order], token[order], kind[order]
        held = np.take(states.reshape(hidden + 1, -1), there, axis=1)
        which = np.arange(len(kind))
        out[token] = _softmax(joined["out"].T @ held, (kind, which))[1]
        if slots is not None:
            out[token] += _softmax(_slot_logits(joined["word"], held, parts), (slots[token], which))[1]
    return out
