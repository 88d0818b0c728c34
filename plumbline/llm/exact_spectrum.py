"""Largest eigenvalues and eigenvectors of an integer symmetric matrix without negative eigenvalues, from its exact polynomial.

1. The characteristic polynomial modulo many primes below 2^31, each by reduction to Hessenberg
   form and its recurrence; Chinese remainders give the integer coefficients. Primes are
   independent, so tasks take a share of them.
2. All roots are real, so the signs of the polynomial shifted to a tell exactly how many roots
   exceed a (Descartes' bound is reached). Halving isolates the distinct roots of the
   square-free part; the count in the whole polynomial is the multiplicity.
3. For each root a task halves its interval to the precision that the distance to its neighbours
   asks for, and finds the null space of (matrix - root) by inverse iteration in long integers.

Repeated and vanishing eigenvalues are thereby told from close ones with certainty.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from math import gcd, isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

PRIMES_PER_TASK = 16
_BEYOND = 128  # bits of a root beyond the distance to its neighbours
_GUARD = 96  # further bits while solving


@dataclass(frozen=True)
class Component:
    """A unit eigenvector, in doubles, and its eigenvalue as ``value / 2**bits``; ``scaled`` is the vector over the eigenvalue's root."""

    value: int
    bits: int
    vector: tuple[float, ...]
    scaled: tuple[float, ...]


# --- polynomial modulo primes -------------------------------------------------------------------


def primes_below_2_31(count: int) -> list[int]:
    """The largest primes below 2^31, falling."""
    span = 64 * count + 2048
    low = 2**31 - span
    small = np.ones(46342, bool)
    small[:2] = False
    for k in range(2, 216):
        if small[k]:
            small[k * k :: k] = False
    sieve = np.ones(span, bool)
    for prime in np.flatnonzero(small).tolist():
        sieve[-low % prime :: prime] = False
    return (np.flatnonzero(sieve)[::-1][:count] + low).tolist()


def _powers(base: np.ndarray, exponent: np.ndarray, modulus: np.ndarray) -> np.ndarray:
    result, base = np.ones_like(base), base.copy()
    while exponent.any():
        result = np.where(exponent & 1, result * base % modulus, result)
        base = base * base % modulus
        exponent = exponent >> 1
    return result


def polynomials_modulo(matrix: Sequence[Sequence[int]], primes: Sequence[int]) -> np.ndarray:
    """det(x - matrix) modulo each prime: coefficients from the constant one up, a row per prime."""
    size, at = len(matrix), np.arange(len(primes))
    p = np.array(primes, np.int64)
    p2, p3 = p[:, None], p[:, None, None]
    a = np.array([[[int(v) % q for v in row] for row in matrix] for q in primes], np.int64).reshape(len(primes), size, size)
    for k in range(size - 2):
        pivot = k + 1 + (a[:, k + 1 :, k] != 0).argmax(axis=1)
        a[at, k + 1], a[at, pivot] = a[at, pivot].copy(), a[at, k + 1].copy()
        a[at, :, k + 1], a[at, :, pivot] = a[at, :, pivot].copy(), a[at, :, k + 1].copy()
        inverse = _powers(a[:, k + 1, k], p - 2, p)
        u = a[:, k + 2 :, k] * inverse[:, None] % p2
        a[:, k + 2 :] = (a[:, k + 2 :] - u[:, :, None] * a[:, k + 1 : k + 2] % p3) % p3
        a[:, :, k + 1] = (a[:, :, k + 1] + (a[:, :, k + 2 :] * u[:, None, :] % p3).sum(axis=2)) % p2
    found = np.zeros((size + 1, len(primes), size + 1), np.int64)
    found[0, :, 0] = 1
    for k in range(1, size + 1):
        poly = np.roll(found[k - 1], 1, axis=1)
        poly = poly - a[:, k - 1, k - 1][:, None] * found[k - 1] % p2
        below = np.ones(len(primes), np.int64)
        for m in range(1, k):
            below = below * a[:, k - m, k - m - 1] % p
            poly = poly - (a[:, k - m - 1, k - 1] * below % p)[:, None] * found[k - m - 1] % p2
            if not m % 16:
                poly %= p2
        found[k] = poly % p2
    return found[size]


def common_modulo(coefficients: Sequence[int], p: int) -> list[int]:
    """The monic greatest common divisor of a polynomial and its derivative modulo a prime."""
    a = [c % p for c in coefficients]
    b = [k * c % p for k, c in enumerate(coefficients)][1:]
    while b and not b[-1]:
        b.pop()
    while b:
        inverse = pow(b[-1], -1, p)
        while len(a) >= len(b):
            factor = a[-1] * inverse % p
            gap = len(a) - len(b)
            for k, c in enumerate(b):
                a[gap + k] = (a[gap + k] - factor * c) % p
            while a and not a[-1]:
                a.pop()
        a, b = b, a
    inverse = pow(a[-1], -1, p)
    return [c * inverse % p for c in a]


def chinese(residues: Sequence[Sequence[int]], primes: Sequence[int]) -> list[int]:
    """Integers of least size with these residues: one row of residues per prime."""
    product = 1
    for p in primes:
        product *= p
    totals = [0] * len(residues[0])
    for row, p in zip(residues, primes):
        rest = product // p
        weight = rest * pow(rest, -1, p)
        for k, residue in enumerate(row):
            totals[k] += residue * weight
    return [(t := total % product) - (product if 2 * t > product else 0) for total in totals]


def divided(coefficients: Sequence[int], monic: Sequence[int]) -> tuple[list[int], list[int]]:
    """Quotient and remainder of an integer polynomial by a monic one."""
    rest, top = list(coefficients), len(monic) - 1
    quotient = [0] * max(len(rest) - top, 0)
    for k in reversed(range(len(quotient))):
        quotient[k] = rest[k + top]
        for j, c in enumerate(monic):
            rest[k + j] -= quotient[k] * c
    return quotient, rest[:top]


# --- real roots ---------------------------------------------------------------------------------


def roots_above(coefficients: Sequence[int], number: int, bits: int = 0) -> int:
    """How many roots of a polynomial with only real roots exceed ``number / 2**bits``, repeated ones as often as they occur."""
    top = len(coefficients) - 1
    c = [value << bits * (top - k) for k, value in enumerate(coefficients)]
    for k in range(top):
        carry = c[top]
        for j in range(top - 1, k - 1, -1):
            carry = c[j] + number * carry
            c[j] = carry
    signs = [value > 0 for value in c if value]
    return sum(x != y for x, y in zip(signs, signs[1:]))


def _sign_at(coefficients: Sequence[int], number: int, bits: int) -> int:
    total = 0
    for k, value in enumerate(reversed(coefficients)):
        total = total * number + (value << bits * k)
    return (total > 0) - (total < 0)


@dataclass(frozen=True)
class Root:
    """The only distinct root in (low, low + 1] / 2**bits; ``above`` are the distinct roots above low, ``times`` how often it occurs."""

    low: int
    bits: int
    above: int
    times: int = 0

    def edge(self, which: int, bits: int) -> int:
        """The lower (0) or upper (1) end in units of 2^-bits."""
        return (self.low + which) << (bits - self.bits)

    def halved(self, simple: Sequence[int]) -> Root:
        middle, bits = 2 * self.low + 1, self.bits + 1
        upper = _above(simple, middle, bits) == self.above
        return Root(middle if upper else middle - 1, bits, self.above, self.times)


def _above(coefficients: Sequence[int], number: int, bits: int) -> int:
    return roots_above(coefficients, number, bits) if bits >= 0 else roots_above(coefficients, number << -bits)


def _apart(upper: Root, lower: Root) -> bool:
    bits = max(upper.bits, lower.bits)
    return upper.edge(0, bits) - lower.edge(1, bits) > 1 << bits - min(upper.bits, lower.bits)


def isolated(whole: Sequence[int], simple: Sequence[int], wanted: int) -> list[Root]:
    """The largest positive roots, falling, until ``wanted`` are counted with repetition, and the next one.

    ``whole`` has only roots that are real and not negative, ``simple`` each of them once. Intervals
    are apart from their neighbours, and from zero, by more than their width.
    """
    bound = max(1, -whole[-2]).bit_length()  # no root exceeds their sum
    todo, found, enough = [(0, -bound, roots_above(simple, 0), 0)], [], False
    while todo and not enough:
        low, bits, above, beyond = todo.pop()  # roots above either end
        if above == beyond:
            continue
        if above - beyond > 1:
            middle = _above(simple, 2 * low + 1, bits + 1)
            todo += [(2 * low, bits + 1, above, middle), (2 * low + 1, bits + 1, middle, beyond)]
            continue
        enough = sum(root.times for root in found) >= wanted
        found.append(Root(low, bits, above, _above(whole, low, bits) - _above(whole, low + 1, bits)))
    for k in range(len(found)):
        while not found[k].low:
            found[k] = found[k].halved(simple)
        while k and not _apart(found[k - 1], found[k]):
            found[k - 1 : k + 1] = [root.halved(simple) for root in found[k - 1 : k + 1]]
    return found


def refined(simple: Sequence[int], root: Root, bits: int) -> int:
    """The root, or its lower neighbour among multiples of 2^-bits; ``bits`` is at least the interval's."""
    low, high = root.edge(0, bits), root.edge(1, bits)
    right = _sign_at(simple, high, bits)
    if not right:
        return high
    while high - low > 1:
        middle = (low + high) >> 1
        sign = _sign_at(simple, middle, bits)
        if not sign:
            return middle
        if sign == right:
            high = middle
        else:
            low = middle
    return low


# --- null spaces --------------------------------------------------------------------------------


def null_space(matrix: Sequence[Sequence[int]], value: int, times: int, bits: int) -> list[list[int]]:
    """Orthonormal vectors, in units of 2^-bits, of the eigenvalue next to ``value / 2**bits``, which occurs so often."""
    size, one = len(matrix), 1 << bits
    a = np.array([[int(v) << bits for v in row] for row in matrix], object).reshape(size, size)
    a[np.arange(size), np.arange(size)] -= value
    order, steps = list(range(size)), []
    for k in range(size):
        pivot = max(range(k, size), key=lambda i: abs(a[i, k]))
        if pivot != k:
            a[[k, pivot]] = a[[pivot, k]]
            order[k], order[pivot] = order[pivot], order[k]
            for step in steps:
                step[[k, pivot]] = step[[pivot, k]]
        if not a[k, k]:
            a[k, k] = 1
        factor = np.zeros(size, object)
        if k + 1 < size:
            factor[k + 1 :] = (a[k + 1 :, k] << bits) // a[k, k]
            a[k + 1 :, k:] -= (factor[k + 1 :, None] * a[k, k:][None, :]) >> bits
        steps.append(factor)

    def solve(right: np.ndarray) -> np.ndarray:
        y = right[order].copy()
        for k in range(size):
            y[k + 1 :] -= (steps[k][k + 1 :] * y[k]) >> bits
        for k in reversed(range(size)):
            y[k] = (y[k] << bits) // a[k, k]
            y[:k] -= (a[:k, k] * y[k]) >> bits
        return y

    def unit(vector: np.ndarray) -> np.ndarray:
        most = max(abs(v) for v in vector)
        shift = most.bit_length() - bits
        vector = vector >> shift if shift > 0 else vector << -shift
        length = isqrt(int((vector * vector).sum()))
        return (vector << bits) // length

    start = np.random.default_rng(size).integers(-(2**40), 2**40, (times, size)).tolist()
    block = [unit(np.array(row, object) << bits) for row in start]
    for _ in range(3):
        grown, block = [unit(solve(vector)) for vector in block], []
        for vector in grown:
            for _ in range(2):
                for other in block:
                    vector = vector - (other * (int((vector * other).sum()) >> bits) >> bits)
                vector = unit(vector)
            block.append(vector)
    assert all(abs(int((v * v).sum()) - one * one) < one << 16 for v in block)
    return [list(v) for v in block]


# --- all together -------------------------------------------------------------------------------


def polynomial(spark: SparkSession, matrix: Sequence[Sequence[int]]) -> tuple[list[int], list[int]]:
    """det(x - matrix) and its square-free part, from residues that tasks compute."""
    size = len(matrix)
    # Coefficients of the polynomial, and of any factor, are at most the product of (1 + root).
    bound = 2 * (2 + sum(matrix[k][k] for k in range(size)) // size) ** size
    count = bound.bit_length() // 30 + 4  # primes have over 30 bits; some to spare
    primes = primes_below_2_31(count)

    def residues(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mine = [primes[k] for k in batch.column(0).to_pylist()]
            rows = polynomials_modulo(matrix, mine).tolist() if mine else []
            common = [common_modulo(row, p) for row, p in zip(rows, mine)]
            kind = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, kind), pa.array(common, kind)], names=["k", "whole", "common"])

    tasks = -(-count // PRIMES_PER_TASK)
    found = spark.range(0, count, 1, tasks).mapInArrow(residues, "k long, whole array<long>, common array<long>").collect()
    whole = chinese([row["whole"] for row in found], [primes[row["k"]] for row in found])
    least = min(len(row["common"]) for row in found)
    if least == 1:
        return whole, whole
    lucky = [row for row in found if len(row["common"]) == least]
    common = chinese([row["common"] for row in lucky], [primes[row["k"]] for row in lucky])
    simple, rest = divided(whole, common)
    if any(rest) or any(divided([k * c for k, c in enumerate(whole)][1:], common)[1]):
        raise ArithmeticError("too few primes keep the common divisor's degree")
    return whole, simple


def largest_components(spark: SparkSession, matrix: Sequence[Sequence[int]], wanted: int) -> list[Component]:
    """Up to so many components with positive eigenvalues, by falling eigenvalue."""
    content = gcd(*(value for row in matrix for value in row)) if matrix else 0
    if not content:
        return []
    matrix = [[value // content for value in row] for row in matrix]
    whole, simple = polynomial(spark, matrix)
    roots = isolated(whole, simple, wanted)
    guard = _GUARD + max(abs(value) for row in matrix for value in row).bit_length()

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in batch.column(0).to_pylist():
                near = [root.bits for root in roots[max(k - 1, 0) : k + 2]]
                bits = max(0, *near) + _BEYOND
                value = refined(simple, roots[k], bits) << guard
                bits += guard
                one = 1 << bits
                length = isqrt(value * content << bits)  # the eigenvalue's root, in units of 2^-bits
                vectors = null_space(matrix, value, roots[k].times, bits)
                plain = [[v / one for v in vector] for vector in vectors]
                scaled = [[v / length for v in vector] for vector in vectors]
                kind = pa.list_(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k]), pa.array([str(value * content)]), pa.array([bits], pa.int32()), pa.array([plain], kind), pa.array([scaled], kind)],
                    names=["k", "value", "bits", "vectors", "scaled"],
                )

    needed, counted = 0, 0
    while needed < len(roots) and counted < wanted:
        counted += roots[needed].times
        needed += 1
    fields = "k long, value string, bits int, vectors array<array<double>>, scaled array<array<double>>"
    found = sorted(spark.range(0, needed, 1, max(needed, 1)).mapInArrow(solve, fields).collect())
    return [
        Component(int(row["value"]), row["bits"], tuple(vector), tuple(scaled))
        for row in found for vector, scaled in zip(row["vectors"], row["scaled"])
    ][:wanted]
