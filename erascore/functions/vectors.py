"""Per-example vector transforms (V1-V10) as built-in array expressions.

All transforms are column expressions (``slice``, ``transform``, ``concat``, ``sequence``), so they
run in the JVM next to the scan, no Python per row. Indexes in the helpers are 0-based, like the
transform specs; ``element_at`` / ``slice`` take 1-based positions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _at(arr: Column, idx: Column | int) -> Column:
    """0-based element access."""
    i = idx if isinstance(idx, Column) else F.lit(idx)
    return F.element_at(arr, i + 1)


def _checked(arr: Column, needed: int, result: Column, what: str) -> Column:
    """``result`` if the input has at least ``needed`` elements, else a task error (Spark's ``slice``
    would silently truncate where the reference fails)."""
    return F.when(F.size(arr) >= F.lit(needed), result).otherwise(
        F.raise_error(F.lit(f"{what}: input vector shorter than {needed}")))


def fill_nan(x, value: float) -> Column:
    """V1: NaN (and NULL) elements -> ``value``."""
    v = F.lit(value).cast("float")
    return F.transform(_c(x), lambda e: F.when(e.isNull() | F.isnan(e), v).otherwise(e))


def vec_slice(x, start: int, size: int) -> Column:
    """V2: ``Slice,from,size``."""
    x = _c(x)
    return _checked(x, start + size, F.slice(x, start + 1, size), "Slice")


def vec_even(x, start: int, n: int) -> Column:
    """V3: ``Even,from,n``: gather indexes from, from+2, ... < 2n, then take n from ``from``."""
    x = _c(x)
    gathered = F.transform(F.sequence(F.lit(start), F.lit(2 * n - 1), F.lit(2)), lambda i: _at(x, i))
    count = len(range(start, 2 * n, 2))
    if start + n > count:
        raise ValueError("Even: slice past the gathered elements")
    return _checked(x, 2 * n - 1, F.slice(gathered, start + 1, n), "Even")


def vec_pad(x, start: int, stop: int) -> Column:
    """V4: ``Pad,from,to,val``: append the first ``to - from`` elements of x (``val`` is unused)."""
    x = _c(x)
    return _checked(x, stop - start, F.concat(x, F.slice(x, 1, stop - start)), "Pad")


def vec_c6(x, y_dim: int, x_dim: int, head: int = 1000, tail: int = 50, times: int = 4,
           channels: int = 6) -> Column:
    """V5: first ``head`` values plus the next ``tail`` each repeated ``times`` in a row, reshaped to
    [channels, y, x] and transposed to [y, x, channels]."""
    x = _c(x)
    flat = F.concat(F.slice(x, 1, head),
                    F.flatten(F.transform(F.slice(x, head + 1, tail), lambda v: F.array_repeat(v, times))))
    if head + tail * times != channels * y_dim * x_dim:
        raise ValueError("C6: sizes do not multiply out")

    def cell(i, j):
        return F.transform(F.sequence(F.lit(0), F.lit(channels - 1)),
                           lambda k: _at(flat, k * (y_dim * x_dim) + i * x_dim + j))

    out = F.transform(F.sequence(F.lit(0), F.lit(y_dim - 1)),
                      lambda i: F.transform(F.sequence(F.lit(0), F.lit(x_dim - 1)), lambda j: cell(i, j)))
    return _checked(x, head + tail, out, "C6")


def vec_zero_pad_rows(x, rows: int, width: int, offsets: list[int]) -> Column:
    """V6: ``ZP,M:N,o0:o1:...``: fragments [o_i, o_i+1) right-padded with zeros to N, stacked M x N."""
    x = _c(x)
    if len(offsets) - 1 != rows:
        raise ValueError("ZP: fragment count differs from the row count")
    frags = []
    for a, b in zip(offsets[:-1], offsets[1:]):
        if b - a > width:
            raise ValueError("ZP: fragment wider than the row")
        frags.append(F.concat(F.slice(x, a + 1, b - a), F.array_repeat(F.lit(0.0).cast("float"), width - (b - a))))
    return _checked(x, offsets[-1], F.array(*frags), "ZP")


def reshape2(x, y_dim: int, x_dim: int) -> Column:
    """V7 ``YX,y,x``: [y][x] row-major."""
    x = _c(x)
    out = F.transform(F.sequence(F.lit(0), F.lit(y_dim - 1)), lambda i: F.slice(x, i * x_dim + 1, x_dim))
    return _checked(x, y_dim * x_dim, out, "YX")


def reshape3(x, a: int, b: int, c: int) -> Column:
    """V7 ``YXZ,y,x,z`` / ``ZYX,z,y,x``: [a][b][c] row-major."""
    x = _c(x)
    out = F.transform(F.sequence(F.lit(0), F.lit(a - 1)), lambda i: F.transform(
        F.sequence(F.lit(0), F.lit(b - 1)), lambda j: F.slice(x, i * (b * c) + j * c + 1, c)))
    return _checked(x, a * b * c, out, "reshape")


def reshape_transpose(x, y_dim: int, x_dim: int) -> Column:
    """V8 ``XY,y,x``: reshape to [x][y], transpose to [y][x]: out[i][j] = x[j*y + i]."""
    x = _c(x)
    out = F.transform(F.sequence(F.lit(0), F.lit(y_dim - 1)), lambda i: F.transform(
        F.sequence(F.lit(0), F.lit(x_dim - 1)), lambda j: _at(x, j * y_dim + i)))
    return _checked(x, y_dim * x_dim, out, "XY")


def class_scale(y, n_classes: int) -> Column:
    """V9 ``Sparse,n``: target x (n - 1)."""
    f = F.lit(float(n_classes - 1)).cast("float")
    return F.transform(_c(y), lambda v: v * f)


# ------------------------------------------------------------------------- spec chain

@dataclass(frozen=True)
class Step:
    name: str
    args: tuple[str, ...]


def parse_spec(spec: str) -> list[Step]:
    """``name,a1,a2[,a3]|...``; ``-`` or empty means no transform. Entries with fewer than two or
    more than three arguments are rejected (the reference drops them silently)."""
    if spec is None or spec.strip() in ("", "-"):
        return []
    steps = []
    for part in spec.split("|"):
        fields = [f.strip() for f in part.split(",")]
        if len(fields) not in (3, 4):
            raise ValueError(f"transform entry needs 2 or 3 arguments: {part!r}")
        steps.append(Step(fields[0], tuple(fields[1:])))
    return steps


def apply_chain(x, y, spec: str | list[Step], training: bool = True) -> tuple[Column, Column]:
    """Apply the parsed transforms in list order; returns (x, y) column expressions.

    ``training=False`` is the scoring path: target-side steps are skipped and ``ZYX`` is ignored as
    in the reference's scorer."""
    steps = parse_spec(spec) if isinstance(spec, str) else spec
    x, y = _c(x), _c(y)
    for s in steps:
        a = s.args
        if s.name == "NaN":
            x = fill_nan(x, float(a[0]))
            if training:
                y = fill_nan(y, float(a[1]))
        elif s.name == "Slice":
            x = vec_slice(x, int(a[0]), int(a[1]))
        elif s.name == "Even":
            x = vec_even(x, int(a[0]), int(a[1]))
        elif s.name == "Pad":
            x = vec_pad(x, int(a[0]), int(a[1]))
        elif s.name == "C6":
            x = vec_c6(x, int(a[0]), int(a[1]))
        elif s.name == "ZP":
            rows, width = (int(v) for v in a[0].split(":"))
            x = vec_zero_pad_rows(x, rows, width, [int(v) for v in a[1].split(":")])
        elif s.name == "YX":
            x = reshape2(x, int(a[0]), int(a[1]))
        elif s.name == "YXZ":
            x = reshape3(x, int(a[0]), int(a[1]), int(a[2]))
        elif s.name == "ZYX":
            if training:
                x = reshape3(x, int(a[0]), int(a[1]), int(a[2]))
        elif s.name == "XY":
            x = reshape_transpose(x, int(a[0]), int(a[1]))
        elif s.name == "Sparse":
            if training:
                y = class_scale(y, int(a[0]))
        else:
            raise ValueError(f"unknown transform {s.name!r}")
    return x, y


def spec_column(spec) -> Column:
    """C6 as a column: a spec string -> ``array<struct<name, args array<string>>>``."""
    entries = F.filter(F.split(F.trim(_c(spec)), r"\|"), lambda e: (e != "") & (e != "-"))
    return F.transform(entries, lambda e: F.struct(
        F.element_at(F.split(e, ","), 1).alias("name"),
        F.slice(F.split(e, ","), 2, 3).alias("args")))


@dataclass(frozen=True)
class Member:
    """A model of an ensemble: what it is, the output it gives and the transform of its inputs."""
    model: str
    arch: str
    version: int
    predict: str
    transform: str


def parse_member(spec: str | None) -> Member | None:
    """``model,arch,version,predict,transform``; ``-`` or empty means no member. Other numbers of fields, and a version
    that is no whole number, raise ValueError."""
    if spec is None or spec.strip() in ("", "-"):
        return None
    fields = [f.strip() for f in spec.split(",")]
    if len(fields) != 5:
        raise ValueError(f"an ensemble member has five fields: {spec!r}")
    return Member(fields[0], fields[1], int(fields[2]), fields[3], fields[4])


def member_column(spec) -> Column:
    """``parse_member`` as a column: ``struct<model, arch, version int, predict, transform>``, null where there is no
    member; a malformed spec fails the query."""
    text = F.trim(_c(spec))
    fields = F.transform(F.split(text, ","), lambda f: F.trim(f))
    malformed = F.raise_error(F.concat(F.lit("an ensemble member has five fields: "), text))
    member = F.struct(fields[0].alias("model"), fields[1].alias("arch"), fields[2].cast("int").alias("version"),
                      fields[3].alias("predict"), fields[4].alias("transform"))
    kind = "struct<model:string,arch:string,version:int,predict:string,transform:string>"
    return (F.when(text.isNull() | text.isin("", "-"), F.lit(None).cast(kind))
            .when((F.size(fields) == 5) & fields[2].try_cast("int").isNotNull(), member).otherwise(malformed.cast(kind)))
