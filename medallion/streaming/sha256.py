"""SHA-256 whose state can be stored: a file is hashed in pieces, by one task after another.

``hashlib`` keeps its state to itself. The state between two blocks is eight numbers, so only the step over
whole blocks is needed from OpenSSL's library, which Python's ``hashlib`` links to. Where a worker's
Python does not give it, the blocks are gone through in Python: the same digest, about a thousand times slower.
"""

from __future__ import annotations

import ctypes
import ctypes.util
import functools
import hashlib
import struct

import pyarrow as pa

# Fixed values of FIPS 180-4: the fractional parts of the roots of the first primes.
_PRIMES = [p for p in range(2, 312) if all(p % q for q in range(2, int(p ** 0.5) + 1))]


def _root(n: int, k: int) -> int:
    """32 bits after the point of the k-th root of n."""
    low, high = 0, 1 << 40
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if mid ** k <= n << 32 * k else (low, mid - 1)
    return low & 0xFFFFFFFF


START = tuple(_root(p, 2) for p in _PRIMES[:8])
_K = [_root(p, 3) for p in _PRIMES[:64]]
BLOCK = 64


class _Context(ctypes.Structure):
    """``SHA256_CTX`` of openssl/sha.h."""

    _fields_ = [("h", ctypes.c_uint32 * 8), ("low", ctypes.c_uint32), ("high", ctypes.c_uint32),
                ("data", ctypes.c_uint32 * 16), ("num", ctypes.c_uint), ("md_len", ctypes.c_uint)]


def _native(lib: ctypes.CDLL, h: tuple[int, ...], blocks: pa.Buffer) -> tuple[int, ...]:
    context = _Context()
    lib.SHA256_Init(ctypes.byref(context))
    context.h[:] = h
    lib.SHA256_Update(ctypes.byref(context), ctypes.c_void_p(blocks.address), ctypes.c_size_t(blocks.size))
    return tuple(context.h)


def _turn(x: int, n: int) -> int:
    return (x >> n | x << 32 - n) & 0xFFFFFFFF


def plain(h: tuple[int, ...], blocks: pa.Buffer) -> tuple[int, ...]:
    for at in range(0, blocks.size, BLOCK):
        w = list(struct.unpack(">16I", blocks.slice(at, BLOCK).to_pybytes()))
        for i in range(16, 64):
            x, y = w[i - 15], w[i - 2]
            w.append((w[i - 16] + (_turn(x, 7) ^ _turn(x, 18) ^ x >> 3) + w[i - 7] + (_turn(y, 17) ^ _turn(y, 19) ^ y >> 10)) & 0xFFFFFFFF)
        a, b, c, d, e, f, g, z = h
        for k, x in zip(_K, w):
            t = z + (_turn(e, 6) ^ _turn(e, 11) ^ _turn(e, 25)) + (e & f ^ ~e & g) + k + x
            u = (_turn(a, 2) ^ _turn(a, 13) ^ _turn(a, 22)) + (a & b ^ a & c ^ b & c)
            a, b, c, d, e, f, g, z = (t + u) & 0xFFFFFFFF, a, b, c, (d + t) & 0xFFFFFFFF, e, f, g
        h = tuple(x + y & 0xFFFFFFFF for x, y in zip(h, (a, b, c, d, e, f, g, z)))
    return h


@functools.cache
def _step():
    """The function over whole blocks: OpenSSL's where it is found and agrees with ``hashlib``."""
    try:
        import _hashlib
        names = [getattr(_hashlib, "__file__", None)]
    except ImportError:
        names = []
    for find in (lambda: next(iter(names), None), lambda: ctypes.util.find_library("crypto")):
        try:
            if name := find():
                step = functools.partial(_native, ctypes.CDLL(name))
                if Sha256(step=step).update(b"abc" * 100).hexdigest() == hashlib.sha256(b"abc" * 100).hexdigest():
                    return step
        except (OSError, AttributeError):  # no such library, or one without these functions
            pass
    return plain


class Sha256:
    def __init__(self, state: bytes | None = None, step=None):
        self.step = step or _step()
        self.h, self.n_bytes, self.tail = START, 0, b""
        if state is not None:
            *h, self.n_bytes = struct.unpack_from(">8IQ", state)
            self.h, self.tail = tuple(h), state[40:]

    def state(self) -> bytes:
        """What a new object needs to go on from here."""
        return struct.pack(">8IQ", *self.h, self.n_bytes) + self.tail

    def update(self, content: bytes | pa.Buffer) -> Sha256:
        content = pa.py_buffer(content) if isinstance(content, bytes) else content
        self.n_bytes += content.size
        at = 0
        if self.tail:
            at = min(BLOCK - len(self.tail), content.size)
            self.tail += content.slice(0, at).to_pybytes()
            if len(self.tail) < BLOCK:
                return self
            self.h = self.step(self.h, pa.py_buffer(self.tail))
        whole = (content.size - at) // BLOCK * BLOCK
        if whole:
            self.h = self.step(self.h, content.slice(at, whole))
        self.tail = content.slice(at + whole).to_pybytes()
        return self

    def hexdigest(self) -> str:
        end = self.tail + b"\x80" + bytes(-(len(self.tail) + 9) % BLOCK) + struct.pack(">Q", 8 * self.n_bytes)
        return struct.pack(">8I", *self.step(self.h, pa.py_buffer(end))).hex()
