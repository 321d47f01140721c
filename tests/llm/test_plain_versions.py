"""Operators that SQL cannot state, written a second time in plain form."""

import math
import random
import string
from collections import Counter

import numpy as np
import xxhash

from tallyfield.llm import bigru, secretscan, weightedsampling

# ---- op1: the network one byte at a time, and all of its gradients


def plain_forward(network, data):
    """Language probabilities of every byte of one text."""
    sigmoid = lambda x: 1 / (1 + np.exp(-x))
    sides = []
    for side, layer in enumerate(network.layers):
        table, turn = layer.table.astype(float), layer.turn.astype(float)
        k = len(turn)
        h, states = np.zeros(k), [None] * len(data)
        for t in reversed(range(len(data))) if side else range(len(data)):
            x, u = table[data[t]], h @ turn
            update, reset = sigmoid(x[:k] + u[:k]), sigmoid(x[k : 2 * k] + u[k : 2 * k])
            new = np.tanh(x[2 * k :] + reset * u[2 * k :])
            h = (1 - update) * new + update * h
            states[t] = h
        sides.append(states)
    out = []
    for a, b in zip(*sides):
        e = np.concatenate([a, b]) @ network.out.astype(float) + network.bias
        e = np.exp(e - e.max())
        out.append(e / e.sum())
    return np.array(out)


def test_network_reads_as_the_plain_one():
    network = bigru.Network(["a", "b", "c"], units=5, seed=9)
    texts = [b"some words", b"x", "größer\n".encode(), bytes(range(256)) + b"tail"]
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.cumsum([0, *map(len, texts)])
    got = network.pooled(data, offsets)
    for row, text in zip(got, texts):
        pieces = [text[i : i + bigru.PIECE] for i in range(0, len(text), bigru.PIECE)]
        want = np.concatenate([plain_forward(network, p) for p in pieces]).mean(axis=0)
        assert np.allclose(row, want, atol=1e-5)


def test_all_gradients_are_numeric_slopes():
    """Input tables, recurrent weights, output and bias, as one step of training computes them."""
    pick = np.random.default_rng(2)
    network = bigru.Network(["a", "b"], units=3)
    for layer in network.layers:
        layer.table, layer.turn = layer.table.astype(float), layer.turn.astype(float)
    network.out, network.bias = network.out.astype(float), network.bias.astype(float)
    x, y = pick.integers(0, 5, (7, 4)), np.array([0, 1, 1, 0])

    def loss():
        p, _ = network.probabilities(x, np.full(7, 4))
        return -np.log(p[:, np.arange(4), y]).mean()

    keep = ([], [])
    p, states = network.probabilities(x, np.full(7, 4), keep)
    p[:, np.arange(4), y] -= 1
    p /= 28
    outer = p @ network.out.T
    found = [g for side, layer in enumerate(network.layers) for g in layer.gradients(x, keep[side], outer[:, :, side * 3 : side * 3 + 3])]
    found += [states.reshape(-1, 6).T @ p.reshape(-1, 2), p.reshape(-1, 2).sum(axis=0)]
    for weights, gradient in zip(network.weights, found):
        for flat in pick.choice(weights.size, min(weights.size, 12), replace=False):
            at = np.unravel_index(flat, weights.shape) if weights.shape[0] != 256 else (int(pick.integers(0, 5)), int(flat) % weights.shape[1])
            held = weights[at]
            weights[at] = held + 1e-2
            up = loss()
            weights[at] = held - 1e-2
            down = loss()
            weights[at] = held
            assert abs((up - down) / 2e-2 - gradient[at]) < 3e-4


# ---- op8: the base patterns character by character

VALUE = set(string.ascii_letters + string.digits + "+/_.=-")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def assigned(text, at):
    """(end, length of the value) of an assignment that begins at a place, or None."""
    for word in ("password", "passwd", "secret", "token", "apikey", "api_key"):
        if lower(text[at : at + len(word)]) == word:
            break
    else:
        return None
    i = at + len(word)
    i += text[i : i + 1] in ('"', "'") and len(text) > i
    while text[i : i + 1] == " ":
        i += 1
    if text[i : i + 1] not in (":", "=") or i >= len(text):
        return None
    i += 1
    while text[i : i + 1] == " ":
        i += 1
    i += text[i : i + 1] in ('"', "'") and len(text) > i
    start = i
    while i < len(text) and text[i] in VALUE:
        i += 1
    return (i, i - start) if i > start else None


def plain_spans(text):
    out, at = [], 0
    while at < len(text):
        found = assigned(text, at)
        if found and found[1] >= 8:
            out.append((at, 0, found[0]))
        at = found[0] if found else at + 1
    at = 0
    while at < len(text):
        end = at + 4
        while end < len(text) and (text[end] in string.ascii_uppercase or text[end] in string.digits):
            end += 1
        if text[at : at + 4] == "AKIA" and end > at + 4:
            if end - at >= 16:
                out.append((at, 1, end))
            at = end
        else:
            at += 1
    at = 0
    while at < len(text):
        end = at
        while end < len(text) and text[end] in "0123456789abcdef":
            end += 1
        if end - at >= 32:
            out.append((at, 2, end))
        at = max(end, at + 1)
    return sorted(out)


def test_base_spans_equal_the_plain_grammar():
    pick = random.Random(3)
    bits = ["password", "PassWD", "passw", "secret", "SECRET", "tokentoken", "token", "api_key", "APIKEY", "api__key", '"', "'", " ", "  ", ":", "=", "==", "::", "\t", "\n", "é", "ſecret",
            "AKIA", "AKIAABCDEFGH1234", "AKIAX", "deadbeef", "0123456789abcdef", "ABCDEF0123456789", "a1", "-", ".", "/x+y_z", "K", "tokKen"]
    seen = Counter()
    for _ in range(6000):
        text = "".join(pick.choice(bits) for _ in range(pick.randint(0, 14)))
        assert secretscan.base_spans(text) == plain_spans(text), text
        seen.update(kind for _, kind, _ in plain_spans(text))
    assert min(seen[k] for k in range(3)) > 30


# ---- op10: consistent weighted sampling word by word


def hashed(*parts):
    seed = 42
    for p in parts:
        data = p if isinstance(p, bytes) else int(p[0]).to_bytes(p[1], "little", signed=True)
        seed = xxhash.xxh64_intdigest(data, seed=seed)
    return seed


def plain_draws(text, samples):
    """The sample of each draw: word and grid step of the least value, as eight hexadecimal digits."""
    counts = Counter(w for w in text.translate(str.maketrans("\t\n\x0b\f\r", "     ")).split(" ") if w)
    if not counts:
        return [weightedsampling.NO_WORD] * samples
    signed = lambda h: h - 2**64 if h >= 2**63 else h
    half = lambda h, shift: (((h >> shift) & 0xFFFFFFFF) + 0.5) / 2**32
    words = {signed(hashed(w.encode())): n for w, n in counts.items()}
    out = []
    for k in range(samples):
        best = None
        for word, n in words.items():
            h = [hashed((word, 8), (k, 4), (i, 4)) for i in range(3)]
            r = -math.log(half(h[0], 0) * half(h[0], 32))
            c = math.log(-math.log(half(h[1], 0) * half(h[1], 32)))
            shift = half(h[2], 32)
            step = math.floor(math.log(n) / r + shift)
            value = c - r * (step - shift) - r
            if best is None or value < best[0]:
                best = (value, f"{hashed((word, 8), (step, 8)):016x}"[8:])
        out.append(best[1])
    return out


def test_fingerprints_equal_plain_sampling(spark, table, docs):
    out = weightedsampling.fingerprints(table).collect()
    by_text = {}
    for d, t in docs:
        if t is None or len(t) < 3000:
            by_text.setdefault(d, set()).add("".join(plain_draws(t or "", weightedsampling.SAMPLES)))
    checked = 0
    for r in out:
        if r["doc_id"] in by_text:
            assert r["fingerprint"] in by_text[r["doc_id"]]
            checked += 1
    assert checked > 50
