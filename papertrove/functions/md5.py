"""MD5 that can be stopped between two blocks of 64 bytes and gone on with elsewhere.

``hashlib`` keeps its chain value to itself. Here it is the 16 bytes that RFC 1321 calls A, B, C and D, so one task can
digest the beginning of a file and another one the rest.
"""

from __future__ import annotations

import ctypes
import hashlib
import math
import struct
from collections.abc import Callable
from functools import lru_cache

BLOCK = 64
START = bytes.fromhex("0123456789abcdeffedcba9876543210")
# Room for OpenSSL's MD5_CTX (92 bytes), which begins with A, B, C and D.
_CONTEXT = 256
_SINES = [int(abs(math.sin(i + 1)) * 2**32) for i in range(64)]
_TURNS = [t for four in ((7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21)) for t in four * 4]
_WORDS = [*range(16), *((5 * i + 1) % 16 for i in range(16)), *((3 * i + 5) % 16 for i in range(16)), *(7 * i % 16 for i in range(16))]


def chain_by_openssl(chain: bytes, blocks: bytes) -> bytes:
    """The chain value after whole blocks, by the library that ``hashlib`` itself is linked with."""
    context = ctypes.create_string_buffer(chain, _CONTEXT)
    _openssl().MD5_Update(context, ctypes.c_char_p(blocks), ctypes.c_size_t(len(blocks)))
    return context.raw[:16]


@lru_cache(1)
def _openssl() -> ctypes.CDLL:
    import _hashlib

    return ctypes.CDLL(_hashlib.__file__)


def chain_by_steps(chain: bytes, blocks: bytes) -> bytes:
    """The same, step by step as in RFC 1321; some hundred times slower."""
    full = 0xFFFFFFFF
    state = struct.unpack("<4I", chain)
    for words in struct.iter_unpack("<16I", blocks):
        a, b, c, d = state
        for i in range(64):
            if i < 16:
                mixed = d ^ (b & (c ^ d))
            elif i < 32:
                mixed = c ^ (d & (b ^ c))
            elif i < 48:
                mixed = b ^ c ^ d
            else:
                mixed = c ^ (b | (d ^ full))
            turned = (a + mixed + _SINES[i] + words[_WORDS[i]]) & full
            turned = (turned << _TURNS[i] | turned >> (32 - _TURNS[i])) & full
            a, b, c, d = d, (b + turned) & full, b, c
        state = tuple((was + now) & full for was, now in zip(state, (a, b, c, d)))
    return struct.pack("<4I", *state)


@lru_cache(1)
def _chain() -> Callable[[bytes, bytes], bytes]:
    """OpenSSL's where it is there and gives the digest it must, else the steps."""
    probe = bytes(range(256)) * 2
    try:
        ended = chain_by_openssl(chain_by_openssl(START, probe[:192]), probe[192:] + _padding(len(probe)))
    except (ImportError, AttributeError, OSError):
        return chain_by_steps
    right = hashlib.md5(probe, usedforsecurity=False).digest()
    return chain_by_openssl if ended == right else chain_by_steps


def _padding(length: int) -> bytes:
    """What MD5 puts behind a text of ``length`` bytes."""
    return b"\x80" + bytes(-(length + 9) % BLOCK) + struct.pack("<Q", 8 * length % 2**64)


def go_on(chain: bytes, tail: bytes, data: bytes) -> tuple[bytes, bytes]:
    """Chain value and bytes of an unfinished block after ``data``, from those before it."""
    data = tail + data
    whole = len(data) - len(data) % BLOCK
    return _chain()(chain, data[:whole]), data[whole:]


def digest(chain: bytes, tail: bytes, length: int) -> str:
    """The digest of all ``length`` bytes gone through, in hex."""
    return _chain()(chain, tail + _padding(length)).hex()
