"""Slow matcher for tests: tries every choice of the next step and scans ahead.

Works on the steps themselves, not on the graph, and on whole sequences of
(ts, {column: value}) with ``holds(text, row)`` deciding conditions.
"""

from __future__ import annotations

from tidewater.operators.pattern.spec import ANY, RELAXED, STRICT


def matches(steps, events, holds, within=None):
    """All matches as tuples of (step name, event index), in no order."""
    found = []
    c = lambda text, j: True if text is None else holds(text, events[j][1])

    def forward(k, kills, fresh, bars, n_out):
        """Options once step k-1 may be left: [(step, kills, bars, veto)] and end."""
        options, veto, end = [], [], False
        first = True
        while True:
            if k == len(steps):
                end = True
                break
            s = steps[k]
            if s.negated:
                (fresh if s.contiguity == STRICT else kills).append(s.condition)
                k += 1
                continue
            options.append((k, list(kills), list(bars) if first else [], list(veto)))
            if not s.optional_:
                break
            if first:
                veto += [b[0] for b in bars]
            first = False
            k += 1
        return options, fresh, kills, end

    def after(k, n, i, items, start):
        """Continue after step k took its n-th event at index i."""
        s = steps[k]
        nxt = steps[k + 1] if k + 1 < len(steps) else None
        armed = [nxt.condition] if nxt is not None and nxt.negated and nxt.contiguity == RELAXED else []
        waits, fresh_kills, at_end = [], [], False
        if s.high is None or n < s.high:
            waits.append(dict(k=k, n=n + 1, mode=s.inner, kill=armed, stop=[s.until_] if s.until_ else [], bar=[], veto=[], need=[]))
        if n >= s.low:
            bars = [(s.condition, s.until_)] if s.greedy_ and s.low != s.high else []
            opts, fresh, kills, end = forward(k + 1, [], [], bars, None)
            fresh_kills += fresh
            for kk, kl, br, veto in opts:
                if br and br[0][1]:
                    waits.append(dict(k=kk, n=1, mode=steps[kk].contiguity, kill=kl, stop=[], bar=[br[0][0]], veto=veto + [br[0][1]], need=[]))
                    waits.append(dict(k=kk, n=1, mode=steps[kk].contiguity, kill=kl, stop=[], bar=[], veto=veto, need=[br[0][1]]))
                else:
                    waits.append(dict(k=kk, n=1, mode=steps[kk].contiguity, kill=kl, stop=[], bar=[b[0] for b in br], veto=veto, need=[]))
            if end and not fresh:
                at_end = True
            if end and fresh and i + 1 < len(events) and in_time(start, i + 1):
                if not any(c(x, i + 1) for x in fresh + kills):
                    found.append(tuple(items))
        if at_end:
            found.append(tuple(items))
        all_fresh = fresh_kills + [x for w in waits for x in w["kill"]]
        for w in waits:
            scan(w, i, items, start, all_fresh)

    def in_time(start, j):
        return within is None or events[j][0] - start < within

    def scan(w, i, items, start, all_fresh):
        t = steps[w["k"]]
        for j in range(i + 1, len(events)):
            if not in_time(start, j):
                return
            fresh = j == i + 1
            if fresh and (any(c(x, j) for x in w["veto"]) or not all(c(x, j) for x in w["need"])):
                return
            killed = any(c(x, j) for x in (all_fresh if fresh else w["kill"]))
            wanted = c(t.condition, j)
            inner = w["n"] > 1
            stop = [t.until_] if t.until_ else []
            if wanted and not any(c(x, j) for x in w["bar"] + stop):
                new = [*items, (t.name, j)]
                if killed:
                    finals = w["n"] >= t.low and all(s.optional_ for s in steps[w["k"] + 1:])
                    if finals:
                        found.append(tuple(new))
                else:
                    after(w["k"], w["n"], j, new, start)
            if killed or w["mode"] == STRICT or (w["mode"] == RELAXED and wanted):
                return
            if any(c(x, j) for x in w["bar"] + (stop if inner else [])):
                return
            assert w["mode"] in (ANY, RELAXED)

    opts, _, _, _ = forward(0, [], [], [], None)
    for j in range(len(events)):
        for k, _, _, _ in opts:
            if c(steps[k].condition, j) and not (steps[k].until_ and c(steps[k].until_, j)):
                after(k, 1, j, [(steps[k].name, j)], events[j][0])
    return found


def skipped(ms, skip):
    """Apply a skip strategy to matches ordered by start and end."""
    ms = sorted(set(ms), key=lambda m: (m[0][1], m[-1][1], m))
    if skip.kind == "none":
        return ms
    out, alive = [], list(ms)
    while alive:
        m = alive.pop(0)
        out.append(m)
        start, end = m[0][1], m[-1][1]
        if skip.kind == "next":
            alive = [x for x in alive if x[0][1] > start]
        elif skip.kind == "past_last":
            alive = [x for x in alive if x[0][1] > end]
        else:
            hits = [j for n, j in m if n == skip.step]
            if hits:
                p = hits[0] if skip.kind == "to_first" else hits[-1]
                alive = [x for x in alive if x[0][1] >= p]
    return out
