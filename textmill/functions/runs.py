"""Run names, size tags and configuration arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from textmill.functions.text import let

# Fixed value: the layout of a run folder, name-vN-size. The name is greedy.
FOLDER_PATTERN = r"^(.+)-v(\d+)-([\d.]+[KMB]?)$"


def _over_tie(x: Column, twice: int, m: Column) -> Column:
    """``x * twice - m`` without rounding error.

    The product is summed from power-of-two multiples, each exact, and the error of every
    addition is kept.
    """
    bits = [b for b in range(twice.bit_length() - 1, -1, -1) if twice >> b & 1]
    total, lost = x * F.lit(float(1 << bits[0])), F.lit(0.0)
    for b in bits[1:]:
        term = x * F.lit(float(1 << b))
        new = total + term
        total, lost = new, lost + (term - (new - total))
    return (total - m) + lost


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def fixed_point(n: Column, scale: Column, digits: int) -> Column:
    """``n / scale`` with ``digits`` decimals, rounded as C's printf rounds the double.

    Only a row that lies at a tie looks at the double's error.
    """
    base = F.lit(10**digits).cast("bigint")

    def rounded(s: Column) -> Column:
        unit = _div(s["scale"], base)
        return F.struct(_div(s["n"], unit).alias("k"), ((s["n"] % unit) * 2 - unit).alias("rest"), (s["n"] / s["scale"].cast("double")).alias("x"))

    def shown(s: Column) -> Column:
        over = _over_tie(s["x"], 2 * 10**digits, (s["k"] * 2 + 1).cast("double"))
        tie_up = F.when(over > 0, 1).when((over == 0) & (s["k"] % 2 == 1), 1).otherwise(0)
        v = s["k"] + F.when(s["rest"] > 0, 1).when(s["rest"] < 0, 0).otherwise(tie_up)
        return F.concat(_div(v, base).cast("string"), F.lit("."), F.lpad((v % base).cast("string"), digits, "0"))

    return let(let(F.struct(n.alias("n"), scale.alias("scale")), rounded), shown)


def size_tag(n: Column, digits: int = 1) -> Column:
    """Parameter count as B, M or K with ``digits`` decimals; '?' when unknown."""

    def tag(v: Column) -> Column:
        by_size = lambda b, m, k: F.when(v >= 10**9, F.lit(b)).when(v >= 10**6, F.lit(m)).otherwise(F.lit(k))
        scale = by_size(10**9, 10**6, 10**3).cast("bigint")
        scaled = F.concat(fixed_point(v, scale, digits), by_size("B", "M", "K"))
        return F.when(v.isNull(), F.lit("?")).when(v < 1000, v.cast("string")).otherwise(scaled)

    return let(n.cast("bigint"), tag)


def parse_folder(folder: Column) -> Column:
    """Struct (name, version, size) of a run folder; null fields when it does not match."""

    def parts(f: Column) -> Column:
        hit = f.rlike(FOLDER_PATTERN)
        part = lambda i: F.when(hit, F.regexp_extract(f, FOLDER_PATTERN, i))
        return F.struct(part(1).alias("name"), part(2).cast("int").alias("version"), part(3).alias("size"))

    return let(folder, parts)


def run_folder(name: Column, version: Column, num_params: Column) -> Column:
    return F.concat(name, F.lit("-v"), version.cast("string"), F.lit("-"), size_tag(num_params))


def param_count(vocab: Column, width: Column, layers: Column, context: Column) -> Column:
    """Parameters of a decoder of the given shape."""
    v, e, n, b = (c.cast("bigint") for c in (vocab, width, layers, context))
    return 2 * v * e + b * e + 2 * e + n * (12 * e * e + 13 * e)


def memory_mib(num_params: Column) -> Column:
    """Struct of MiB for weights, optimiser state, gradients and their sum."""
    part = lambda k: num_params * F.lit(float(k)) / F.lit(1048576.0)
    return F.struct(
        part(4).alias("weights"), part(8).alias("optimizer"), part(4).alias("gradients"), part(16).alias("total")
    )
