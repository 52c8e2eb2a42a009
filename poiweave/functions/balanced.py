"""Pairs of marks matched by depth, in time linear in the text but for sorting the marks.

The text is split at the marks, and only their places are worked on. Depth is a running sum over the marks, taken without a loop:
of the marks in order, the one at place j that is the k-th opening has k openings and j - k closings before it. Of the
marks sorted by depth and place, an opening and the closing behind it are a pair; marks that
are left open or never opened take part in none, and stay. What pairs cut out is merged by the same running sum over the
edges of the cuts, and the rest is joined.

All steps are SQL expressions for ``with_steps``; they need no look at the text beyond its marks.
"""

from __future__ import annotations


def _events(first: str, second: str) -> str:
    """Places of both kinds in order, each with its rank among its kind (``k``) and whether it opens (``up``)."""
    kinds = [f"transform({places}, (at, k) -> named_struct('at', at, 'k', k, 'up', {up}))" for places, up in ((first, "true"), (second, "false"))]
    return f"sort_array(concat({kinds[0]}, {kinds[1]}))"


def _places(marks: str, wanted: list[str], value: str) -> str:
    """``value`` of the index ``i`` of each wanted mark, in order."""
    test = " or ".join(f"m = '{w}'" for w in wanted)
    return f"filter(transform({marks}, (m, i) -> if({test}, {value}, null)), x -> x is not null)"


def paired_steps(
    name: str, text: str, opening: str, closing: str, pattern: str, whole: str = "true", separator: str = ""
) -> dict[str, str]:
    """Steps that end in ``name``: ``text`` without its pairs of ``opening`` and ``closing``.

    ``pattern`` finds the marks. ``whole`` says of a pair, by the text ``p`` behind its opening, whether all of it goes; of any
    other pair only its marks go, and what stands before its last own ``separator``. Inner pairs are treated alike, and go
    with the pair around them.
    """
    col = lambda part: f"_{name.lstrip('_')}_{part}"
    marks, pieces, tokens = col("marks"), col("pieces"), col("tokens")
    chain, ends, pairs, cuts, edges, kept = (col(c) for c in ("chain", "ends", "pairs", "cuts", "edges", "kept"))
    both = [separator] if separator else []
    # A separator closes what is before it and opens what is behind it, at the same depth.
    ups, downs = _places(marks, [opening, *both], "2 * i + 1"), _places(marks, [closing, *both], "2 * i")
    level = "if(e.up, 2 * e.k + 1 - j, j - 2 * e.k)"
    of_mark = f"get({marks}, cast(e.at div 2 as int))"
    levelled = (
        f"named_struct('level', {level}, 'mark', cast(e.at div 2 as int), 'up', e.up, 'between', {of_mark} = '{separator}')"
    )
    before, after = f"get({chain}, j - 1)", f"get({ends}, j + 1)"
    last = f"if({before}.between and {before}.level = e.level, {before}.mark, null)"
    a_pair = f"e.up and not {after}.up and {after}.level = e.level"
    inside = whole.replace("{p}", f"get({pieces}, x.first + 1)")
    one = "array(named_struct('a', x.first, 'b', x.last))"
    two = "array(named_struct('a', x.first, 'b', coalesce(x.cut, x.first)), named_struct('a', x.last, 'b', x.last))"
    starts = f"transform(sort_array(transform({cuts}, c -> c.a)), a -> 2 * a)"
    stops = f"transform(sort_array(transform({cuts}, c -> c.b)), b -> 2 * b + 1)"
    beyond = f"coalesce(get({edges}, j + 1).at, 2 * size({marks}))"
    steps = {
        marks: f"regexp_extract_all({text}, r'({pattern})', 0)",
        pieces: f"split({text}, r'{pattern}', -1)",
        col("events"): _events(ups, downs),
        chain: f"sort_array(filter(transform({col('events')}, (e, j) -> {levelled}), x -> not (x.up and x.between)))",
        ends: f"filter(transform({chain}, (e, j) -> named_struct('level', e.level, 'mark', e.mark, 'up', e.up, 'between', e.between, 'cut', {last})), x -> not x.between)",
        pairs: f"filter(transform({ends}, (e, j) -> named_struct('first', e.mark, 'last', if({a_pair}, {after}.mark, null), 'cut', {after}.cut)), x -> x.last is not null)",
        cuts: f"flatten(transform({pairs}, x -> if({inside}, {one}, {two})))",
        edges: _events(starts, stops),
        # Pieces at even places, the marks between them at odd ones.
        tokens: f"flatten(transform({pieces}, (p, i) -> if(i < size({marks}), array(p, get({marks}, i)), array(p))))",
        kept: f"filter(transform({edges}, (e, j) -> named_struct('from', e.at + 1, 'to', {beyond}, 'free', not e.up and j = 2 * e.k + 1)), x -> x.free)",
    }
    body = (
        f"if(size({cuts}) = 0, {text}, concat(array_join(slice({tokens}, 1, get({edges}, 0).at + 1), ''), "
        f"array_join(flatten(transform({kept}, x -> slice({tokens}, x.from + 1, x.to - x.from + 1))), '')))"
    )
    # Each step is bound to a name for those behind it, in one expression: texts without both marks skip it all, and the
    # code generated for a row stays small enough to be compiled.
    for step, sql in reversed(steps.items()):
        body = f"element_at(transform(array({sql}), {step} -> {body}), 1)"
    return {name: f"if(contains({text}, '{opening}') and contains({text}, '{closing}'), {body}, {text})"}
