"""The few pieces of Python that run inside tasks.

Registered for pickling by value, so executors need no copy of this package.
Every kernel streams over Arrow batches and keeps constant state.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCALE = 10_000


TOP_TIER = 3


def clamp_scan(add, low, high):
    """Inclusive scan of maps x -> min(high, max(low, x + add)), first one applied first.

    Two such maps compose to a third one, so doubling the reach of every row's map
    takes log2(n) vector steps.  A row whose low equals its high is a constant: what
    came before it has no effect, which is how a new key begins.
    """
    import numpy as np

    add, low, high = (np.array(v, np.int64) for v in (add, low, high))
    reach = 1
    while reach < len(add):
        a, lo, hi = add[reach:], low[reach:], high[reach:]
        new = (add[:-reach] + a, np.clip(low[:-reach] + a, lo, hi), np.clip(high[:-reach] + a, lo, hi))
        add, low, high = (np.concatenate([v[:reach], n]) for v, n in zip((add, low, high), new))
        reach *= 2
    return add, low, high


def _key_starts(*columns):
    import numpy as np

    first = np.ones(len(columns[0]), bool)
    if len(first) > 1:
        first[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    return first


def tier_walk(batches):
    """Saturating walk over tiers 0..3 along rows sorted by (learner_id, seg, ts, event_id).

    Adds the tier before and after every row; a segment starts at start_tier.
    """
    import numpy as np

    key, tier = None, 0
    for pdf in batches:
        if not len(pdf):
            continue
        learner, seg, step = (pdf[c].to_numpy() for c in ("learner_id", "seg", "shift"))
        start = pdf["start_tier"].to_numpy().astype(np.int64)
        first = _key_starts(learner, seg)
        if key == (learner[0], seg[0]):
            start[0] = tier
        begun = np.clip(start + step, 0, TOP_TIER)
        _, after, _ = clamp_scan(np.where(first, 0, step), np.where(first, begun, 0), np.where(first, begun, TOP_TIER))
        before = np.where(first, start, np.concatenate([[0], after[:-1]]))
        key, tier = (learner[-1], seg[-1]), int(after[-1])
        yield pdf.assign(tier_before=before.astype(np.int32), tier=after.astype(np.int32))


def segment_effect(batches):
    """Per (learner_id, seg): rows, and the map x -> min(high, max(low, x + add)) that the segment is."""
    import numpy as np
    import pandas as pd

    columns = ["learner_id", "seg", "n", "add", "low", "high"]
    held = None
    for pdf in batches:
        if not len(pdf):
            continue
        learner, seg, step = (pdf[c].to_numpy() for c in columns[:2] + ["shift"])
        at = np.flatnonzero(_key_starts(learner, seg))
        n = np.diff(np.append(at, len(pdf)))
        # the maps of each run, composed by a scan that starts anew at the run's first row
        place = np.arange(len(pdf)) - np.repeat(at, n)
        a, lo, hi = step.astype(np.int64), np.zeros(len(pdf), np.int64), np.full(len(pdf), TOP_TIER)
        reach = 1
        while reach < n.max():
            own = np.flatnonzero(place >= reach)
            prev = own - reach
            new = a[prev] + a[own], np.clip(lo[prev] + a[own], lo[own], hi[own]), np.clip(hi[prev] + a[own], lo[own], hi[own])
            a[own], lo[own], hi[own] = new
            reach *= 2
        last = at + n - 1
        add, low, high = a[last], lo[last], hi[last]
        out = pd.DataFrame(dict(zip(columns, (learner[at], seg[at], n, add, low, high))))
        if held is not None:
            if held[:2] == (learner[0], seg[0]):
                _, _, m, a0, l0, h0 = held
                out.loc[0, columns[2:]] = (m + n[0], a0 + add[0], min(max(l0 + add[0], low[0]), high[0]), min(max(h0 + add[0], low[0]), high[0]))
            else:
                yield pd.DataFrame([held], columns=columns)
        held = tuple(out.iloc[-1])
        yield out.iloc[:-1]
    if held is not None:
        yield pd.DataFrame([held], columns=columns)


def segment_starts(batches):
    """Start tier and rows before each segment, over the maps of segments sorted per learner."""
    import numpy as np

    key, tier, rows = None, 0, 0
    for pdf in batches:
        if not len(pdf):
            continue
        learner, n = pdf["learner_id"].to_numpy(), pdf["n"].to_numpy().astype(np.int64)
        add, low, high = (pdf[c].to_numpy().astype(np.int64) for c in ("add", "low", "high"))
        first = _key_starts(learner)
        begin, before = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64)
        if key == learner[0]:
            begin[0], before[0] = tier, rows
        begun = np.clip(begin + add, low, high)
        _, after, _ = clamp_scan(np.where(first, 0, add), np.where(first, begun, low), np.where(first, begun, high))
        group = np.cumsum(first) - 1
        total = np.cumsum(n)
        at = np.flatnonzero(first)
        upto = total - (total[at] - n[at])[group] + before[at][group]
        starts = np.where(first, begin, np.concatenate([[0], after[:-1]]))
        key, tier, rows = learner[-1], int(after[-1]), int(upto[-1])
        yield pdf[["learner_id", "seg"]].assign(start_tier=starts.astype(np.int32), rows_before=upto - n)


def walk_on(scores, tier, tail, rules):
    """Tier after each of an array of scores (whole units), from a tier and the scores before them; (tiers, the last scores)."""
    import numpy as np

    window, advance, regress = rules
    both = np.concatenate([np.array(tail, np.int64), scores])
    total = np.concatenate([[0], np.cumsum(both)])
    step = np.zeros(len(scores), np.int64)
    full = np.arange(len(both))[len(tail):] >= window - 1
    at = np.flatnonzero(full) + len(tail) + 1
    sums = total[at] - total[at - window]
    step[full] = np.where(sums >= advance, 1, np.where(sums < regress, -1, 0))
    low, high = np.zeros(len(scores), np.int64), np.full(len(scores), TOP_TIER)
    if len(scores):
        low[0] = high[0] = min(TOP_TIER, max(0, tier + int(step[0])))
    _, after, _ = clamp_scan(step, low, high)
    return after, both[max(0, len(both) - window + 1):].tolist()


def tier_processor(rules, chunk=512):
    """Stateful processor: the tier walk of one learner, kept up for scores that come in any order.

    State: pages of at most `chunk` scores in event order, each with the walk's state
    at its start; and the first instant of every page.  New scores after all known ones
    only touch the last page.  A late one rewrites the walk from its page on, and the
    rows from its place on are emitted again under a new version (their number in the
    history has changed).
    """
    from pyspark.sql.streaming import StatefulProcessor

    class TierProcessor(StatefulProcessor):
        def init(self, handle):
            self.pages = handle.getMapState("pages", "page bigint", "us array<bigint>, event_id array<bigint>, score array<bigint>, tier bigint, n bigint, tail array<bigint>")
            self.index = handle.getValueState("index", "us array<bigint>, event_id array<bigint>, version bigint")

        def handleInputRows(self, key, rows, timer_values):
            import bisect

            import numpy as np
            import pandas as pd

            fresh = pd.concat(list(rows), ignore_index=True).sort_values(["us", "event_id"], kind="stable")
            us, event, score = (fresh[c].to_numpy(np.int64) for c in ("us", "event_id", "score"))
            first_us, first_event, version = ([], [], -1) if not self.index.exists() else (list(v) if k < 2 else v for k, v in enumerate(self.index.get()))
            # the page that the first new score falls into, and all after it
            page = max(0, bisect.bisect_right(list(zip(first_us, first_event)), (int(us[0]), int(event[0]))) - 1)
            tier, n, tail, emit_from = 0, 0, [], None
            old = [self.pages.getValue((k,)) for k in range(page, len(first_us))]
            if old:
                tier, n, tail = int(old[0][3]), int(old[0][4]), list(old[0][5])
                place = np.lexsort((event, us))
                known = [np.concatenate([np.array(p[c], np.int64) for p in old]) for c in range(3)]
                is_new = np.concatenate([np.zeros(len(known[0]), bool), np.ones(len(place), bool)])
                us, event, score = (np.concatenate([k, f]) for k, f in zip(known, (us, event, score)))
                order = np.lexsort((is_new, event, us))
                us, event, score, is_new = us[order], event[order], score[order], is_new[order]
                emit_from = int(is_new.argmax())
            after, _ = walk_on(score, tier, tail, rules)
            out = pd.DataFrame({"learner_id": key[0], "event_id": event, "episode_no": n + 1 + np.arange(len(event)), "tier": after.astype(np.int32),
                                "version": version + 1})
            first_us, first_event = first_us[:page], first_event[:page]
            joined = tail + score.tolist()
            for k, at in enumerate(range(0, len(us), chunk)):
                begin = len(tail) + at
                self.pages.updateValue((page + k,), (
                    us[at:at + chunk].tolist(), event[at:at + chunk].tolist(), score[at:at + chunk].tolist(),
                    int(after[at - 1]) if at else tier, n + at, joined[max(0, begin - rules[0] + 1):begin]))
                first_us.append(int(us[at]))
                first_event.append(int(event[at]))
            self.index.update((first_us, first_event, version + 1))
            yield out.iloc[emit_from or 0:]

        def close(self):
            pass

    return TierProcessor()


def session_processor(gap_ms):
    """Stateful processor: runs of activity of a group of users that end after an idle gap, closed by event-time timers.

    A row before the watermark is late, for the run it belongs to may be closed: it goes
    out as such and changes nothing.  The runs still open of a user go out again under a new version whenever
    they change; a run that its timer closes goes out for good.

    A key is a group of users, so that calls and state reads are paid per group: the runs
    of all its users are arrays, and one timer stands for the run that ends first.  Users
    without an id are a group of their own, whose key is null.
    """
    from pyspark.sql.streaming import StatefulProcessor

    class SessionProcessor(StatefulProcessor):
        def init(self, handle):
            self.handle = handle
            # runs: 64-bit users, starts, ends and counts, one after the other; timer: the earliest one that is set, -1 for none
            self.open = handle.getValueState("open", "runs binary, version bigint, timer bigint")

        def _state(self):
            import numpy as np

            if not self.open.exists():
                return np.zeros((4, 0), np.int64), 0, -1
            runs, version, timer = self.open.get()
            return np.frombuffer(bytes(runs), np.int64).reshape(4, -1), int(version), int(timer)

        def _keep(self, runs, version, timer):
            """Store the runs, with a timer for the first that ends (a run is over a millisecond after its gap)."""
            if runs.shape[1]:
                due = int(runs[2].min()) // 1000 + gap_ms + 1
                if timer < 0 or due < timer:
                    self.handle.registerTimer(due)
                    timer = due
            self.open.update((runs.tobytes(), version, timer))

        def _frame(self, key, kind, runs, version, event_id=None):
            import pandas as pd

            user, lo, hi, n = runs
            return pd.DataFrame({"user_id": pd.array([None] * len(user) if pd.isna(key[0]) else user, "Int64"), "kind": kind, "lo": lo, "hi": hi, "n": n,
                                 "event_id": pd.array([None] * len(user) if event_id is None else event_id, "Int64"), "version": version})

        def _changed(self, key, runs, users, version):
            """The open runs of users; one row of nothing tells that a user's newest version has none."""
            import numpy as np

            mine = runs[:, np.isin(runs[0], users)]
            gone = np.setdiff1d(users, mine[0])
            return self._frame(key, "open", np.concatenate([mine, [gone, *np.zeros((3, len(gone)), np.int64)]], axis=1), version)

        def handleInputRows(self, key, rows, timer_values):
            import numpy as np
            import pandas as pd

            fresh = pd.concat(list(rows), ignore_index=True)
            gap, mark = gap_ms * 1000, timer_values.getCurrentWatermarkInMs()
            us = fresh["us"].to_numpy(np.int64)
            user = np.zeros(len(us), np.int64) if pd.isna(key[0]) else fresh["user_id"].to_numpy(np.int64)
            late = us // 1000 < mark
            if late.any():
                yield self._frame(key, "late", np.stack([user[late], us[late], us[late], np.ones(late.sum(), np.int64)]), 0, fresh["event_id"].to_numpy()[late].astype(np.int64))
            if late.all():
                return
            runs, version, timer = self._state()
            user, us = user[~late], us[~late]
            # runs of the new rows, then those of both, by the same rule
            runs = np.concatenate([runs, np.stack([user, us, us, np.ones(len(us), np.int64)])], axis=1)
            runs = runs[:, np.lexsort((runs[1], runs[0]))]
            top = pd.Series(runs[2]).groupby(runs[0]).cummax().to_numpy()
            at = np.flatnonzero(np.concatenate([[True], (runs[0, 1:] != runs[0, :-1]) | (runs[1, 1:] - top[:-1] >= gap)]))
            runs = np.stack([runs[0, at], runs[1, at], np.maximum.reduceat(runs[2], at), np.add.reduceat(runs[3], at)])
            self._keep(runs, version + 1, timer)
            yield self._changed(key, runs, np.unique(user), version + 1)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            import numpy as np

            mark = timerValues.getCurrentWatermarkInMs()
            runs, version, timer = self._state()
            done = runs[2] // 1000 + gap_ms < mark
            if not done.any() and timer > mark:  # a timer of a run that has grown since, or that went with an earlier timer
                return
            left = runs[:, ~done]
            self._keep(left, version + 1, timer if timer > mark else -1)
            if done.any():
                yield self._frame(key, "closed", runs[:, done], 0)
                yield self._changed(key, left, np.unique(runs[0, done]), version + 1)

        def close(self):
            pass

    return SessionProcessor()


def action_json(texts):
    """First JSON object with an action_type inside free text, as JSON text.

    NULL input stays NULL, so rows that already parsed cost nothing here.  Whether a
    JSON value starts at a brace or bracket, and where it ends, does not depend on what
    is around it.  So the places are taken from the right, and a value that starts
    inside another one is known by the time the outer one is looked at: every stretch of
    text is read once, whatever the nesting, and no depth or length is too much.
    """
    import json
    import re

    import pandas as pd

    blank = re.compile(r"[ \t\n\r]*")
    plain = re.compile(r'"(?:[^"\\\x00-\x1f]|\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4}))*"|-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?|true|false|null|NaN|-?Infinity')
    string = re.compile(r'"(?:[^"\\\x00-\x1f]|\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4}))*"')

    def value_end(text, at, ends):
        if text[at:at + 1] in ("{", "["):
            return ends.get(at)
        found = plain.match(text, at)
        return found and found.end()

    def container(text, start, ends):
        """(end, whether action_type is a member) of the object or array at `start`, or None if none starts there."""
        is_object, close = text[start] == "{", "}" if text[start] == "{" else "]"
        at, has = blank.match(text, start + 1).end(), False
        if text[at:at + 1] == close:
            return at + 1, False
        while True:
            if is_object:
                key = string.match(text, at)
                if not key:
                    return None
                has = has or json.loads(key.group()) == "action_type"
                at = blank.match(text, key.end()).end()
                if text[at:at + 1] != ":":
                    return None
                at = blank.match(text, at + 1).end()
            at = value_end(text, at, ends)
            if at is None:
                return None
            at = blank.match(text, at).end()
            if text[at:at + 1] == close:
                return at + 1, has
            if text[at:at + 1] != ",":
                return None
            at = blank.match(text, at + 1).end()

    def search(text):
        first, ends = None, {}
        for found in reversed(list(re.finditer(r"[{\[]", text))):
            start = found.start()
            known = container(text, start, ends)
            if known:
                ends[start] = known[0]
                first = (start, known[0]) if known[1] else first
        return text[first[0]:first[1]] if first else None

    return pd.Series([search(t) if isinstance(t, str) else None for t in texts], dtype="object")


def passage_finder(passages):
    """Task: (id, item) for every text (id, text) that holds a passage verbatim; passages: (item, text) pairs of one shard."""
    import pyarrow as pa

    def run(batches):
        import ahocorasick

        places = {}
        for k, (_, text) in enumerate(passages):
            places.setdefault(text, []).append(k)
        automaton = ahocorasick.Automaton()
        for text, at in places.items():
            automaton.add_word(text, at)
        automaton.make_automaton()
        items = pa.array([i for i, _ in passages])
        for batch in batches:
            rows, hits = [], []
            for k, text in enumerate(batch.column(1)):
                found = {j for _, at in automaton.iter(text.as_py() or "") for j in at}
                rows += [k] * len(found)
                hits += sorted(found)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), items.take(pa.array(hits, pa.int64()))], names=["id", "item"])

    return run


def _score_terminal(gained, gap, step):
    from decimal import ROUND_HALF_UP, Decimal
    raw = gained / SCALE / (gap / SCALE) * 0.60 + (1.0 - step / 50.0) * 0.20 + 0.10
    ten = Decimal(repr(raw)).quantize(Decimal("1e-10"), ROUND_HALF_UP)
    return min(9990, max(10, int(ten.quantize(Decimal("1e-4"), ROUND_HALF_UP) * SCALE)))


def _half_up(numerator, denominator):
    """Rounded integer quotient, halves away from zero."""
    sign = -1 if numerator < 0 else 1
    return sign * ((2 * abs(numerator) + denominator) // (2 * denominator))


def score_step(state, action, perf, grade, rules):
    """One step of an episode; amounts are integers in 1/10000.

    state: [steps, run, baseline, prev_perf, best_gain, total, done, last_action]
    Returns the raw reward and changes state in place.
    """
    steps, run, base, prev, best_gain = state[:5]
    step = steps + 1
    if steps == 0:
        base = prev = perf
    delta = perf - prev
    run = run + 1 if action == state[7] else 1
    terminal, report = action in rules["terminal"], action == "submit_report"
    reward = rules["step"].get(action, rules["default"])
    if delta:
        reward += min(4000, max(-4000, _half_up(delta * 4, 1000)))
    gap = max(SCALE, 100 * SCALE - base)
    usable = base > 0 and perf > 0
    gained = perf - base
    if usable:
        for share, bonus in rules["milestones"]:
            if gained * 100 >= share * gap and (best_gain is None or best_gain * 100 < share * gap):
                reward += bonus
        best_gain = gained if best_gain is None else max(best_gain, gained)
    if report:
        reward += _score_terminal(gained, gap, step) if usable else 1000
    elif grade is not None:
        reward += _half_up(grade * rules["share"].get(action, 0), 10)
    if step <= 35 and ((report and usable) or (terminal and not report and (grade or 0) >= 5000)):
        reward += (50 - step) * 20
    if run >= 2:
        reward -= 800 * min(run - 1, 3)
    if action == "request_hint":
        reward -= 1000
    if delta < -SCALE:
        reward -= 500
    if step >= 48 and not terminal:
        reward -= 1500
    reward = min(9990, max(10, reward))
    done = terminal or step >= 50 or (grade or 0) >= SCALE or perf >= rules["target"]
    state[:] = [step, run, base, perf, best_gain, state[5] + reward, done, action]
    return reward


def first_rows(chunks, order, limit):
    """The first `limit` rows of one key; never holds more than a chunk beyond that."""
    import pandas as pd

    kept = None
    for pdf in chunks:
        kept = pdf if kept is None else pd.concat([kept, pdf], ignore_index=True)
        kept = kept.sort_values(order).head(limit)
    return kept


def step_processor(rules, most=50):
    """Stateful processor: scores the steps of one episode in event order, in whatever order they arrive.

    The state is the first `most` steps by time that have been seen; later ones
    can never count.  A batch that changes them scores the episode again and
    emits all its live steps under a new version, which replaces the one before.
    """
    from pyspark.sql.streaming import StatefulProcessor

    columns = ["us", "event_id", "action_type", "perf", "grade"]

    class StepProcessor(StatefulProcessor):
        def init(self, handle):
            self.steps = handle.getListState("steps", "us bigint, event_id bigint, action_type string, perf bigint, grade bigint")
            self.version = handle.getValueState("version", "version bigint")

        def handleInputRows(self, key, rows, timer_values):
            import pandas as pd

            fresh = first_rows(rows, columns[:2], most)[columns]
            fresh = [(int(us), int(event), action, int(perf), None if pd.isna(grade) else int(grade))
                     for us, event, action, perf, grade in fresh.itertuples(index=False)]
            before = [tuple(r) for r in self.steps.get()] if self.steps.exists() else []
            kept = sorted(before + fresh, key=lambda r: r[:2])[:most]
            if kept == before:
                return
            version = self.version.get()[0] + 1 if self.version.exists() else 0
            self.steps.put(kept)
            self.version.update((version,))
            state, out = [0, 0, 0, 0, None, 0, False, None], []
            for _, event, action, perf, grade in kept:
                reward = score_step(state, action, perf, grade, rules)
                out.append((key[0], event, state[0], reward / SCALE, state[5] / SCALE, state[6], version))
                if state[6]:
                    break
            yield pd.DataFrame(out, columns=["episode_id", "event_id", "step_no", "reward", "total_reward", "done", "version"])

        def close(self):
            pass

    return StepProcessor()
