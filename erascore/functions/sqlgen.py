"""Small helpers that write SQL text for the DuckDB oracles (not used by the Spark operators)."""

from __future__ import annotations

from itertools import permutations


def _perm_sign(p: tuple[int, ...]) -> int:
    sign, seen = 1, list(p)
    for i in range(len(seen)):
        while seen[i] != i:
            j = seen[i]
            seen[i], seen[j] = seen[j], seen[i]
            sign = -sign
    return sign


def determinant(entry) -> str:
    """Leibniz expansion of a k x k determinant; ``entry(i, j)`` returns the SQL of one cell."""
    k = entry.k
    terms = []
    for p in permutations(range(k)):
        prod = " * ".join(entry(i, p[i]) for i in range(k))
        terms.append(("+ " if _perm_sign(p) > 0 else "- ") + f"({prod})")
    return "(" + " ".join(terms) + ")"


class _Gram:
    def __init__(self, k: int, replace_col: int | None = None):
        self.k = k
        self.replace_col = replace_col

    def __call__(self, i: int, j: int) -> str:
        if self.replace_col is not None and j == self.replace_col:
            return f"b{i}"
        a, b = min(i, j), max(i, j)
        return f"g{a}_{b}"


def gram_sums(features: list[str], score: str) -> str:
    """SELECT-list of the normal-equation sums g{i}_{j} = sum(fi*fj), b{i} = sum(fi*score)."""
    k = len(features)
    parts = [f"sum({features[i]} * {features[j]}) AS g{i}_{j}" for i in range(k) for j in range(i, k)]
    parts += [f"sum({features[i]} * {score}) AS b{i}" for i in range(k)]
    return ", ".join(parts)


def cramer_solution(k: int) -> str:
    """SELECT-list of beta{j} from the g/b columns by Cramer's rule."""
    det = determinant(_Gram(k))
    return ", ".join(f"{determinant(_Gram(k, j))} / {det} AS beta{j}" for j in range(k))
