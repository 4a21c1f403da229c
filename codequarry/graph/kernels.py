"""Algorithms on the control flow of one method: plain functions over adjacency, run once for each method."""

from __future__ import annotations


def post_order(succ: dict[int, list[int]], entry: int) -> list[int]:
    """Nodes reached from entry, each behind its successors (but for back edges), by an explicit stack."""
    out, seen, stack = [], {entry}, [(entry, iter(succ.get(entry, ())))]
    while stack:
        node, rest = stack[-1]
        for n in rest:
            if n not in seen:
                seen.add(n)
                stack.append((n, iter(succ.get(n, ()))))
                break
        else:
            out.append(node)
            stack.pop()
    return out


def reversed_graph(succ: dict[int, list[int]]) -> dict[int, list[int]]:
    pred: dict[int, list[int]] = {}
    for a, bs in succ.items():
        for b in bs:
            pred.setdefault(b, []).append(a)
    return pred


def immediate_dominators(succ: dict[int, list[int]], entry: int) -> dict[int, int]:
    """node -> its immediate dominator, for nodes reached from entry but entry itself."""
    order = post_order(succ, entry)
    number = {n: i for i, n in enumerate(order)}
    pred = reversed_graph({n: succ.get(n, []) for n in order})
    idom = {entry: entry}
    changed = True
    while changed:
        changed = False
        for n in reversed(order):
            if n == entry:
                continue
            best = None
            for p in pred.get(n, ()):
                if p not in idom:
                    continue
                if best is None:
                    best = p
                    continue
                a, b = p, best
                while a != b:
                    while number[a] < number[b]:
                        a = idom[a]
                    while number[b] < number[a]:
                        b = idom[b]
                best = a
            if best is not None and idom.get(n) != best:
                idom[n] = best
                changed = True
    del idom[entry]
    return idom


def frontiers(succ: dict[int, list[int]], idom: dict[int, int]) -> dict[int, set[int]]:
    """node -> its dominance frontier: where its dominance ends. Only nodes with one are listed."""
    out: dict[int, set[int]] = {}
    for n, ps in reversed_graph(succ).items():
        if len(ps) < 2:
            continue
        for p in ps:
            while p in idom and p != idom.get(n):
                out.setdefault(p, set()).add(n)
                p = idom[p]
    return out


EXIT = -1


def with_exit(succ: dict[int, list[int]], nodes: list[int], exit_: int | None) -> tuple[dict[int, list[int]], int]:
    """The flow with one exit: the given one, or a node of its own behind every node that nothing follows."""
    if exit_ is not None:
        return succ, exit_
    out = {n: list(succ.get(n, [])) for n in nodes}
    for n in nodes:
        if not out[n]:
            out[n] = [EXIT]
    return out, EXIT


def reaching(succ: dict[int, list[int]], nodes: list[int], gen: dict[int, set[int]], kill: dict[int, set[int]]) -> dict[int, set[int]]:
    """Definitions that reach each node's entry: the least fixpoint of in = union of out over predecessors, out = gen + (in - kill),
    by a worklist; definitions are bits of whole numbers."""
    ids = sorted({d for ds in gen.values() for d in ds} | {d for ds in kill.values() for d in ds})
    bit = {d: 1 << i for i, d in enumerate(ids)}
    mask = lambda ds: sum(bit[d] for d in ds)
    g, k = {n: mask(gen.get(n, ())) for n in nodes}, {n: mask(kill.get(n, ())) for n in nodes}
    pred = reversed_graph(succ)
    inn, out = dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0)
    work, queued = list(nodes), set(nodes)
    while work:
        n = work.pop(0)
        queued.discard(n)
        i = 0
        for p in pred.get(n, ()):
            i |= out.get(p, 0)
        o = g[n] | (i & ~k[n])
        inn[n] = i
        if o != out[n]:
            out[n] = o
            for s in succ.get(n, ()):
                if s not in queued and s in out:
                    queued.add(s)
                    work.append(s)
    return {n: {d for d in ids if inn[n] & bit[d]} for n in nodes}
