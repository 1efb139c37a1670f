"""Polygon boundaries as arrays of edges, and the strict containment test on them, as SQL expression text.

An edge is a struct (xlo, ylo, xhi, yhi) that runs upwards: ylo <= yhi. A point is inside a polygon member when a ray to
the right crosses an odd number of its edges (holes included) and the point lies on none of them. Exactness on the
boundary is that of double arithmetic.
"""

from __future__ import annotations

# Added to the crossing count for an edge that holds the point; far above any possible number of edges.
ON_EDGE = 1 << 40


def member_edges(members: str) -> str:
    """``array<members>`` -> ``array<array<edge>>``: the edges of all rings of a member in one array."""
    # The last position is paired with the first one: that closes an open ring, and adds a zero-length edge to a closed one.
    following = "concat(slice(ring, 2, size(ring)), slice(ring, 1, 1))"
    edges_of_ring = f"zip_with(ring, {following}, (a, b) -> {_upward_edge('a', 'b')})"
    return f"transform({members}, rings -> flatten(transform(rings, ring -> {edges_of_ring})))"


def _upward_edge(a: str, b: str) -> str:
    ax, ay, bx, by = f"get({a}, 0)", f"get({a}, 1)", f"get({b}, 0)", f"get({b}, 1)"
    return (
        f"if({ay} <= {by}, struct({ax} as xlo, {ay} as ylo, {bx} as xhi, {by} as yhi), "
        f"struct({bx} as xlo, {by} as ylo, {ax} as xhi, {ay} as yhi))"
    )


def left_end(edge: str) -> str:
    return f"least({edge}.xlo, {edge}.xhi)"


def right_end(edge: str) -> str:
    return f"greatest({edge}.xlo, {edge}.xhi)"


def side(x: str, y: str, e: str = "e") -> str:
    """> 0: the point lies to the left of the upward edge; 0: on its line."""
    return f"(({e}.xhi - {e}.xlo) * (({y}) - {e}.ylo) - (({x}) - {e}.xlo) * ({e}.yhi - {e}.ylo))"


def _right_of(x: str, y: str) -> str:
    """The edge lies to the right of the point, its upper end left out."""
    return f"(({y}) >= e.ylo and ({y}) < e.yhi and {side(x, y)} > 0)"


def _above(x: str, y: str) -> str:
    """The edge lies above the point, its right end left out; at a touch, if it rises to the right."""
    across = f"{left_end('e')} <= ({x}) and ({x}) < {right_end('e')}"
    height = f"case when e.ylo = e.yhi then ({y}) < e.ylo when e.xlo < e.xhi then {side(x, y)} <= 0 else {side(x, y)} > 0 end"
    return f"({across} and {height})"


def _on_edge(x: str, y: str) -> str:
    within = f"({y}) between e.ylo and e.yhi and ({x}) between {left_end('e')} and {right_end('e')}"
    return f"({within} and {side(x, y)} = 0)"


def inside(x: str, y: str, edges: str) -> str:
    """Strictly inside the member bounded by ``edges``."""
    weight = f"case when {_on_edge(x, y)} then {ON_EDGE}L when {_right_of(x, y)} then 1L else 0L end"
    return f"aggregate({edges}, 0L, (n, e) -> n + {weight}, n -> n < {ON_EDGE}L and n % 2 = 1)"


def _legs(x: str, y: str, right: str, top: str) -> str:
    """How often the way from (x, y) right to (right, y) and up to (right, top) crosses the edge ``e``, up to parity.

    It crosses where one of the tests changes. The tests at (right, y) have one form for both legs, so that rounding cannot
    count an edge on one leg and miss it on the other.
    """
    return f"if({_right_of(x, y)} <> {_right_of(right, y)}, 1L, 0L) + if({_above(right, y)} <> {_above(right, top)}, 1L, 0L)"


def inside_cell(x: str, y: str, right: str, top: str, edges: str, odd: str) -> str:
    """The same from the edges that meet a cell, and from whether its corner (right, top) is inside (``odd``)."""
    weight = f"case when {_on_edge(x, y)} then {ON_EDGE}L else {_legs(x, y, right, top)} end"
    start = f"if({odd}, 1L, 0L)"
    return f"aggregate({edges}, {start}, (n, e) -> n + {weight}, n -> n < {ON_EDGE}L and n % 2 = 1)"


def odd_in_cell(x: str, y: str, right: str, top: str, edges: str, odd: str) -> str:
    """Whether an odd number of edges lies to the right of (x, y), a corner inside the cell; on an edge or not."""
    return f"aggregate({edges}, if({odd}, 1L, 0L), (n, e) -> n + {_legs(x, y, right, top)}, n -> n % 2 = 1)"


def odd_from_all(x: str, y: str, edges: str) -> str:
    """The same from all edges of a member."""
    return f"aggregate({edges}, 0L, (n, e) -> n + if({_right_of(x, y)}, 1L, 0L), n -> n % 2 = 1)"


def meets_box(left: str, bottom: str, right: str, top: str, size: str) -> str:
    """The edge ``e`` meets a closed box of side ``size``, or comes as near to it as rounding can tell."""
    # Of the four corners, the one farthest to the left of the edge's line and the one farthest to the right: which these
    # are depends on which way it leans only, also after rounding.
    rises = "e.xhi >= e.xlo"
    most, least = side(left, f"if({rises}, {top}, {bottom})"), side(right, f"if({rises}, {bottom}, {top})")
    # Boxes beside the line of the edge do not meet it; the margin is far above any rounding.
    margin = f"1e-9D * (abs(e.xhi - e.xlo) + abs(e.yhi - e.ylo)) * (abs(e.xlo) + abs(e.ylo) + abs(e.xhi) + abs(e.yhi) + {size})"
    beside = f"{left_end('e')} <= {right} and {right_end('e')} >= {left} and e.ylo <= {top} and e.yhi >= {bottom}"
    return f"({beside} and {most} >= -({margin}) and {least} <= {margin})"


def crossings_left(first: str, last: str, top: str) -> str:
    """The number of the first cell whose right border, at height ``top``, the edge ``e`` is not to the right of.

    ``first`` and ``last`` are the numbers of the cells its ends are in.
    """
    columns = f"sequence({first} - 1, {last})"
    return f"{first} - 1 + size(filter({columns}, c -> {_right_of('(c + 1) * side', top)}))"


def inside_any(x: str, y: str, members: str) -> str:
    return f"exists({members}, edges -> {inside(x, y, 'edges')})"
