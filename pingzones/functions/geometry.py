"""Planar point-in-polygon tests over an array of edges, as SQL expressions.

An edge is ``struct<ax, ay, bx, by: double>``.  The edges of all rings of all
parts of a zone are kept together: even-odd parity then takes care of holes and
of several parts.  Both tests use the sign of the same cross product, so they
agree on which side of an edge a point lies.

That sign is exact for coordinates as they are written, in decimal digits.  Where
the product is no larger than what rounding may have done to it, it is worked out
again in decimal numbers, which takes up to 15 digits after the point.
"""

from __future__ import annotations

EDGE_TYPE = "struct<ax:double,ay:double,bx:double,by:double>"
# Holds a coordinate, and a difference of two; a product of two takes 36 digits.
_EXACT = "DECIMAL(18, 15)"


def rounding_bound(reach: float, extent: float) -> float:
    """What rounding may add to a cross product of coordinates up to ``reach``, ``extent`` apart.

    Each of its four differences is off by at most the spacing of numbers near
    ``reach``, and is multiplied by a difference of at most ``extent``.
    """
    return 8 * 2.0**-52 * reach * extent


def cross(e: str, x: str, y: str) -> str:
    """Positive left of the edge a-b, negative right of it, zero on its line."""
    return f"(({e}.bx - {e}.ax) * ({y} - {e}.ay) - ({e}.by - {e}.ay) * ({x} - {e}.ax))"


def _exact_products(e: str, x: str, y: str) -> tuple[str, str]:
    """The two products whose difference is the cross product; null if a number is too large."""

    def difference(a: str, b: str) -> str:
        return f"try_cast(try_cast({a} AS {_EXACT}) - try_cast({b} AS {_EXACT}) AS {_EXACT})"

    return (
        f"{difference(f'{e}.bx', f'{e}.ax')} * {difference(y, f'{e}.ay')}",
        f"{difference(f'{e}.by', f'{e}.ay')} * {difference(x, f'{e}.ax')}",
    )


def is_left(e: str, x: str, y: str, bound: float = 0.0) -> str:
    """Whether a point lies left of the edge a-b and not on its line."""
    left, right = _exact_products(e, x, y)
    c = cross(e, x, y)
    return f"""CASE WHEN {c} > {bound!r}D THEN true WHEN {c} < -{bound!r}D THEN false
        ELSE coalesce({left} > {right}, {c} > 0) END"""


def is_on_line(e: str, x: str, y: str, bound: float = 0.0) -> str:
    left, right = _exact_products(e, x, y)
    c = cross(e, x, y)
    return f"(abs({c}) <= {bound!r}D AND coalesce({left} = {right}, {c} = 0))"


def odd_crossings(edges: str, x: str, y: str, bound: float = 0.0) -> str:
    """True when an odd number of edges meet the ray that leaves (x, y) eastwards."""
    meets = f"(e.ay > {y}) <> (e.by > {y}) AND ({is_left('e', x, y, bound)}) = (e.by > e.ay)"
    return f"aggregate({edges}, false, (odd, e) -> odd <> ({meets}))"


def on_any_edge(edges: str, x: str, y: str, bound: float = 0.0) -> str:
    return f"""exists({edges}, e ->
        {x} BETWEEN least(e.ax, e.bx) AND greatest(e.ax, e.bx)
        AND {y} BETWEEN least(e.ay, e.by) AND greatest(e.ay, e.by)
        AND {is_on_line('e', x, y, bound)})"""


def strictly_inside(edges: str, x: str, y: str, bound: float = 0.0) -> str:
    """Inside and not on the border; ``bound`` as of ``rounding_bound``."""
    return f"({odd_crossings(edges, x, y, bound)} AND NOT {on_any_edge(edges, x, y, bound)})"


def ring_edges(rings: str) -> str:
    """Edges of closed or unclosed rings (``array<array<array<double>>>``)."""
    one_ring = """zip_with(ring, concat(slice(ring, 2, greatest(size(ring), 1)), slice(ring, 1, 1)),
        (a, b) -> named_struct('ax', get(a, 0), 'ay', get(a, 1), 'bx', get(b, 0), 'by', get(b, 1)))"""
    # A closed ring repeats its first vertex, which gives one edge of no length.
    return f"""filter(flatten(transform({rings}, ring -> {one_ring})),
        e -> e.ax <> e.bx OR e.ay <> e.by)"""
