"""SHA-256 whose state can be kept, stored and resumed, for many messages at a time.

Messages here are sequences of digests in lower-case hex. A digest in hex is exactly one
64-byte block, so the state after some digests is eight 32-bit words and nothing else.
States and digests are arrays of shape (n, 8); each call handles all n in a few numpy
operations a round.
"""

from __future__ import annotations

import numpy as np

#: Bytes of a state, and of a digest.
STATE_BYTES = 32


def _root_bits(prime: int, power: int) -> int:
    """First 32 bits of the fraction of the square or cube root of a prime."""
    scaled, low, high = prime << (32 * power), 0, 1 << 40
    while low + 1 < high:
        middle = (low + high) // 2
        low, high = (middle, high) if middle**power <= scaled else (low, middle)
    return low & 0xFFFFFFFF


_PRIMES = [n for n in range(2, 312) if all(n % d for d in range(2, int(n**0.5) + 1))]
_ROUND = np.array([_root_bits(p, 3) for p in _PRIMES[:64]], dtype=np.uint32)
#: State before the first block.
START = np.array([_root_bits(p, 2) for p in _PRIMES[:8]], dtype=np.uint32)

_HEX = np.frombuffer("".join(f"{i:02x}" for i in range(256)).encode(), dtype=np.uint16)


def _turn(x: np.ndarray, n: int) -> np.ndarray:
    return (x >> np.uint32(n)) | (x << np.uint32(32 - n))


def absorb(states: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """States after one more block each; ``blocks`` has shape (16, n), big-endian words."""
    w = list(blocks)
    for t in range(16, 64):
        a, b = w[t - 15], w[t - 2]
        small = _turn(a, 7) ^ _turn(a, 18) ^ (a >> np.uint32(3))
        large = _turn(b, 17) ^ _turn(b, 19) ^ (b >> np.uint32(10))
        w.append(w[t - 16] + small + w[t - 7] + large)
    before = states.T
    a, b, c, d, e, f, g, h = before
    for t in range(64):
        first = h + (_turn(e, 6) ^ _turn(e, 11) ^ _turn(e, 25)) + (g ^ (e & (f ^ g)))
        first = first + (w[t] + _ROUND[t])
        second = (_turn(a, 2) ^ _turn(a, 13) ^ _turn(a, 22)) + ((a & b) | (c & (a | b)))
        a, b, c, d, e, f, g, h = first + second, a, b, c, d + first, e, f, g
    return (before + np.stack([a, b, c, d, e, f, g, h])).T


def hex_block(digests: np.ndarray) -> np.ndarray:
    """Digests in hex as blocks for :func:`absorb`."""
    raw = digests.astype(">u4").view(np.uint8).reshape(len(digests), STATE_BYTES)
    return np.ascontiguousarray(_HEX[raw].view(">u4").astype(np.uint32).T)


def finish(states: np.ndarray, blocks: np.ndarray | int) -> np.ndarray:
    """Digests of messages of so many whole blocks."""
    n = len(states)
    last = np.zeros((16, n), dtype=np.uint32)
    last[0] = 0x80000000
    bits = np.broadcast_to(np.asarray(blocks, dtype=np.uint64) * np.uint64(512), n)
    last[14] = (bits >> np.uint64(32)).astype(np.uint32)
    last[15] = (bits & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    return absorb(states, last)


def started(n: int) -> np.ndarray:
    return np.tile(START, (n, 1))


def to_bytes(words: np.ndarray) -> list[bytes]:
    """One value of 32 bytes for each row."""
    raw = words.astype(">u4").tobytes()
    return [raw[at : at + STATE_BYTES] for at in range(0, len(raw), STATE_BYTES)]


def from_bytes(values: bytes) -> np.ndarray:
    return np.frombuffer(values, dtype=">u4").astype(np.uint32).reshape(-1, 8)
