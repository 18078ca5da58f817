"""Searches over the stored runs and walks of one day, each worked off by one task as far as its answers need.

A task reads the runs and walks once, as plain arrays of about 50 bytes a hop, and then takes its searches one after the other.
Nothing here looks at a stop, a run or a time that a search does not come to, so the work follows the searches. The tables
are read from the folder that all executors share, through its file system's own library; a task holds those of the day.

``latest_departures`` goes back in time from the destination's deadline, event by event, until the origins are reached: an event
is a time by which a stop can still be left with so much walking to come (to walk on, or to ride on after the transfer time), or an
arrival at a stop that is reached. Each of a stop's times comes once, with less walking than all later ones.

``kept_labels`` makes the labels of ``journeys.py`` in rounds of one leg. It leaves out those that no origin can come to in time
and within the walking budget when it is left at a given time at the earliest (``_reach``, without transfer times and with stops
passed more than once). What such a label dominates, or goes on to, is left out as well, so of the others the same are kept.

Functions here travel to the executors by value and use Python, numpy, pyarrow and xxhash only.
"""

from __future__ import annotations

import struct
import sys
from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from heapq import heappop, heappush
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import cloudpickle
from xxhash import xxh64_intdigest

from stopwise.config import WALKING

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: No journey leaves before.
EVER = -(1 << 31)
#: After every place of a run.
NEVER = (1 << 31) - 1
#: Rows that a task gives back at once.
ANSWERS = 4096
SEED = 42


class Network(NamedTuple):
    """Hops in the order of runs, and by the stops at their ends; walks by the stops at theirs."""

    stops: dict[str, int]
    names: list[str]
    trips: pa.Array
    trip: memoryview
    run: memoryview
    first: memoryview
    past: memoryview
    place: memoryview
    until: memoryview
    board: memoryview
    dep: memoryview
    alight: memoryview
    arr: memoryview
    repeats: bytes
    into: memoryview
    into_at: memoryview
    into_time: memoryview
    out: memoryview
    out_at: memoryview
    out_time: memoryview
    walks_into: dict[int, list[tuple[int, int, int]]]
    walks_from: dict[int, list[tuple[int, int, int]]]
    part: memoryview
    crossings: dict[int, list[tuple[int, int]]]
    crossings_back: dict[int, list[tuple[int, int]]]


def _ints(values) -> memoryview:
    return memoryview(np.ascontiguousarray(values, dtype=np.int32))


def _read(folder: str, columns: list[str]) -> pa.Table:
    system, path = fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")
    return pq.read_table(path, filesystem=system, columns=columns)


def _parts(stops: int, board: np.ndarray, alight: np.ndarray) -> np.ndarray:
    """A number for each stop, the same for stops that hops connect, whatever their direction."""
    part = np.arange(stops)
    while True:
        before = part.copy()
        least = np.minimum(part[board], part[alight])
        np.minimum.at(part, board, least)
        np.minimum.at(part, alight, least)
        part = part[part]
        if (part == before).all():
            return part


def read_network(runs: str, walks: str) -> Network:
    """The tables that ``journeys.stored_network`` wrote, as arrays."""
    table = _read(runs, ["trip_id", "boardings"]).combine_chunks()
    trips = pa.array(table["trip_id"].combine_chunks(), pa.string()).dictionary_encode()
    lists = table["boardings"].combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy()) if len(lists) else np.zeros(0, np.int64)
    hops = lists.flatten()
    on_foot = _read(walks, ["at_stop_id", "start_stop_id", "walk_s", "takes_s"])
    ends = [hops.field("stop_id"), hops.field("next_stop_id"), *(on_foot[c].combine_chunks() for c in ("at_stop_id", "start_stop_id"))]
    coded = pa.concat_arrays([pa.array(e, pa.string()) for e in ends]).dictionary_encode()
    codes = coded.indices.fill_null(-1).to_numpy(zero_copy_only=False)
    names = coded.dictionary.to_pylist()
    n, w = len(hops), on_foot.num_rows
    board, alight, at, start = codes[:n], codes[n : 2 * n], codes[2 * n : 2 * n + w], codes[2 * n + w :]
    field = lambda c, none=0: hops.field(c).fill_null(none).to_numpy(zero_copy_only=False)
    run = np.repeat(np.arange(len(sizes)), sizes)
    past = np.cumsum(sizes)
    until, dep, arr = field("until", NEVER), field("dep_s"), field("arr_s")
    repeats = np.zeros(len(sizes), bool)
    repeats[run[until < NEVER]] = True
    into, out = np.lexsort((arr, alight)), np.lexsort((dep, board))
    spots = np.arange(len(names) + 1)
    into_walks, from_walks = defaultdict(list), defaultdict(list)
    part = _parts(len(names), board, alight)
    least: dict[tuple[int, int], int] = {}
    for a, s, walk, takes in zip(at.tolist(), start.tolist(), on_foot["walk_s"].to_pylist(), on_foot["takes_s"].to_pylist()):
        into_walks[a].append((s, walk, takes))
        from_walks[s].append((a, walk, takes))
        if part[s] != part[a]:
            pair = int(part[s]), int(part[a])
            least[pair] = min(walk, least.get(pair, walk))
    crossings, crossings_back = defaultdict(list), defaultdict(list)
    for (s, a), walk in least.items():
        crossings[s].append((a, walk))
        crossings_back[a].append((s, walk))
    return Network(
        {name: i for i, name in enumerate(names)}, names, trips.dictionary, _ints(trips.indices.fill_null(-1)),
        _ints(run), _ints((past - sizes)[run]), _ints(past[run]), _ints(field("place")), _ints(until), _ints(board), _ints(dep),
        _ints(alight), _ints(arr), repeats.tobytes(),
        _ints(into), _ints(np.searchsorted(alight[into], spots)), _ints(arr[into]),
        _ints(out), _ints(np.searchsorted(board[out], spots)), _ints(dep[out]), dict(into_walks), dict(from_walks),
        _ints(part), dict(crossings), dict(crossings_back),
    )


def walking_room(parts: set[int], crossings: dict[int, list[tuple[int, int]]], budget_s: int) -> dict[int, int]:
    """By the parts of the network that can be reached from ``parts``: the walking left there, were rides free within a part."""
    room: dict[int, int] = {}
    heap = [(0, p) for p in parts]
    while heap:
        walked, part = heappop(heap)
        if part not in room:
            room[part] = max(budget_s, 0) - walked
            for to, walk in crossings.get(part, ()):
                if walked + walk <= budget_s and to not in room:
                    heappush(heap, (walked + walk, to))
    return room


def latest_departures(net: Network, end: int, arrival_s: int, budget_s: int, transfer_s: int, origins: set[int], least_s: int) -> dict[int, tuple[int, int]]:
    """For each origin that reaches ``end`` by ``arrival_s``, the latest time to leave it, ``least_s`` or later, and the least walking then."""
    board, dep, place, until, first, run_of, repeats = net.board, net.dep, net.place, net.until, net.first, net.run, net.repeats
    into, into_at, into_time, walks_into = net.into, net.into_at, net.into_time, net.walks_into
    # An event is (time, latest first; kind; walking; stop or place in a stop's arrivals): kind 0 walks on, 1 rides on, 2 arrives.
    events = [(-arrival_s, 0, 0, end), (transfer_s - arrival_s, 1, 0, end)]
    walked: dict[int, int] = {}
    ridden: dict[int, int] = {}
    scanned: dict[int, int] = {}
    found: dict[int, tuple[int, int]] = {}
    open_ = set(origins)
    part_of = net.part
    room = walking_room({part_of[o] for o in origins}, net.crossings, budget_s)
    if part_of[end] not in room:
        return found
    while events:
        early, kind, w, at = heappop(events)
        if kind == 0:
            if w >= walked.get(at, NEVER):
                continue
            walked[at] = w
            if at in open_:
                found[at] = -early, w
                open_.discard(at)
                if not open_:
                    break
            for start, walk, takes in walks_into.get(at, ()):
                further = w + walk
                if further <= budget_s and -early - takes >= 0 and further <= room.get(part_of[start], -1) and further < walked.get(start, NEVER):
                    heappush(events, (early + takes, 0, further, start))
                    heappush(events, (early + takes, 1, further, start))
            continue
        if kind == 1:
            if w >= ridden.get(at, NEVER):
                continue
            begun = at in ridden
            ridden[at] = w
            if not begun:
                low = into_at[at]
                i = bisect_right(into_time, -early, low, into_at[at + 1]) - 1
                if i >= low and into_time[i] >= 0:
                    heappush(events, (-into_time[i], 2, at, i))
            continue
        # ``w`` is the stop, ``at`` the place in its arrivals.
        stop, i = w, at
        hop, w = into[i], ridden[stop]
        if i > into_at[stop] and into_time[i - 1] >= 0:
            heappush(events, (-into_time[i - 1], 2, stop, i - 1))
        run = run_of[hop]
        if not repeats[run]:
            if w >= scanned.get(run, NEVER):
                continue
            scanned[run] = w
        seq, low = place[hop], first[hop]
        while hop >= low and until[hop] > seq + 1:
            start, leaves = board[hop], dep[hop]
            if leaves >= least_s:
                if w < walked.get(start, NEVER):
                    heappush(events, (-leaves, 0, w, start))
                if w < ridden.get(start, NEVER):
                    heappush(events, (transfer_s - leaves, 1, w, start))
            hop -= 1
    return found


class Label(NamedTuple):
    """From ``stop`` the destination can be made when leaving at ``dep_s``: by one leg, then as ``parent`` says."""

    stop: int
    dep_s: int
    ride_by_s: int
    walked_s: int
    transfers: int
    label_id: int
    trip: int
    run: int
    arr_s: int | None
    walk_s: int | None
    visited: frozenset[int]
    path: tuple[int, ...]
    parent: "Label | None"


#: What stands for a trip in the label of the destination and in those that walk.
NO_TRIP, WALK = -2, -3


def _reach(net: Network, leave: dict[int, int], end: int, arrival_s: int, budget_s: int) -> dict[int, tuple[list[int], list[int]]]:
    """Where one can be by when and with how much walking, if origins are left at their times of ``leave`` or later.

    Each stop has its times, rising, with the least walking that any earlier time has, falling. Changes take no time here
    and stops may be passed twice, so all that a journey can do is in it.
    """
    out, out_at, out_time, run_of = net.out, net.out_at, net.out_time, net.run
    past, alight, arr, walks_from = net.past, net.alight, net.arr, net.walks_from
    part_of, room = net.part, walking_room({net.part[end]}, net.crossings_back, budget_s)
    events = sorted((time, 0, 0, stop) for stop, time in leave.items() if part_of[stop] in room)
    reach: dict[int, tuple[list[int], list[int]]] = {}
    least: dict[int, int] = {}
    scanned: dict[int, int] = {}
    while events:
        time, kind, w, at = heappop(events)
        if kind == 0:
            known = least.get(at, NEVER)
            if w >= known:
                continue
            least[at] = w
            times, walks = reach.setdefault(at, ([], []))
            times.append(time)
            walks.append(w)
            for to, walk, takes in walks_from.get(at, ()):
                if w + walk <= budget_s and time + takes <= arrival_s and w + walk <= room.get(part_of[to], -1) and w + walk < least.get(to, NEVER):
                    heappush(events, (time + takes, 0, w + walk, to))
            if known == NEVER:
                i = bisect_left(out_time, time, out_at[at], out_at[at + 1])
                if i < out_at[at + 1]:
                    heappush(events, (out_time[i], 1, at, i))
            continue
        # ``w`` is the stop, ``at`` the place in its departures.
        if time > arrival_s:
            break
        stop, i = w, at
        hop, w = out[i], least[stop]
        if i + 1 < out_at[stop + 1]:
            heappush(events, (out_time[i + 1], 1, stop, i + 1))
        run = run_of[hop]
        if w >= scanned.get(run, NEVER):
            continue
        scanned[run] = w
        end = past[hop]
        while hop < end and arr[hop] <= arrival_s:
            if w < least.get(alight[hop], NEVER):
                heappush(events, (arr[hop], 0, w, alight[hop]))
            hop += 1
    return reach


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def kept_labels(
    net: Network,
    search_id: int,
    end: int,
    arrival_s: int,
    budget_s: int,
    width: int,
    transfer_s: int,
    leave: dict[int, int] | None,
    max_legs: int | None,
    wide: bool,
    fold_rows: int,
) -> list[Label]:
    """The labels of a search in rounds of one leg, without those that no origin of ``leave`` comes to in time.

    A label stays if labels of fewer than ``width`` branches dominate it. The candidates of a stop are folded whenever ``fold_rows``
    of them have come together, and at the end of the round: a candidate that some of the others drop would be dropped by all, as
    where one of its dominators goes later, that one's own dominators are in its branch or in as many branches by themselves.
    With ``leave`` None there is no pruning at all.
    """
    board, dep, arr, place, until, first = net.board, net.dep, net.arr, net.place, net.until, net.first
    into, into_at, into_time, run_of, trip_of = net.into, net.into_at, net.into_time, net.run, net.trip
    prune = leave is not None
    reach = _reach(net, leave, end, arrival_s, budget_s) if prune else {}
    room = max(budget_s, 0)
    number = struct.Struct("<q" if wide else "<i").pack
    long = struct.Struct("<q").pack
    trip_bytes: dict[int, bytes] = {}

    def useful(stop: int, time: int, walked: int) -> bool:
        if not prune:
            return True
        at = reach.get(stop)
        i = bisect_right(at[0], time) if at else 0
        return i > 0 and at[1][i - 1] + walked <= room

    if prune and not useful(end, arrival_s, 0):
        return []
    labels = [Label(end, arrival_s, arrival_s - transfer_s, 0, 0, search_id, NO_TRIP, -1, None, None, frozenset((end,)), (), None)]
    kept = list(labels)
    # Of each stop the labels kept, in the order in which each follows all that dominate it.
    known: dict[int, list[tuple]] = defaultdict(list)
    candidates: dict[int, list[tuple]] = {}
    folded: dict[int, int] = {}

    def add(stop: int, candidate: tuple) -> None:
        waiting = candidates.setdefault(stop, [])
        waiting.append(candidate)
        if prune and len(waiting) >= folded.get(stop, 0) + fold_rows:
            candidates[stop] = _folded(known[stop], waiting, width)
            folded[stop] = len(candidates[stop])

    legs = n = 0
    while labels and (max_legs is None or legs < max_legs):
        legs += 1
        for label in labels:
            stop, visited = label.stop, label.visited
            hashed = xxh64_intdigest(long(label.label_id), SEED)
            earliest = max(reach[stop][0][0], 0) if prune else 0
            low, high = into_at[stop], into_at[stop + 1]
            for i in range(bisect_left(into_time, earliest, low, high), bisect_right(into_time, label.ride_by_s, low, high)):
                end_hop = hop = into[i]
                run = run_of[hop]
                trip = trip_of[run]
                if run == label.run or trip < 0:
                    continue
                seq, start, ridden = place[hop], first[hop], None
                while hop >= start and until[hop] > seq + 1:
                    at = board[hop]
                    # Where one of these holds it holds for all earlier stops of the run.
                    if at < 0 or at in visited or not useful(at, dep[hop], label.walked_s):
                        break
                    if ridden is None:
                        if trip not in trip_bytes:
                            trip_bytes[trip] = net.trips[trip].as_py().encode()
                        ridden = xxh64_intdigest(trip_bytes[trip], hashed)
                        changes = label.transfers + (label.trip != NO_TRIP and label.trip != trip)
                    label_id = xxh64_intdigest(number(seq + 1), xxh64_intdigest(number(place[hop] + 1), ridden))
                    n += 1
                    add(at, (label.walked_s, -dep[hop], transfer_s - dep[hop], 1, changes, _signed(label_id), n, label, trip, run, hop, end_hop, None))
                    hop -= 1
            for start, walk, takes in net.walks_into.get(stop, ()):
                walked, leaves = label.walked_s + walk, label.dep_s - takes
                if walked <= budget_s and leaves >= 0 and start not in visited and useful(start, leaves, walked):
                    label_id = xxh64_intdigest(net.names[start].encode(), xxh64_intdigest(WALKING.encode(), hashed))
                    changes = label.transfers + (label.trip != NO_TRIP and label.trip != WALK)
                    n += 1
                    add(start, (walked, -leaves, -leaves, 1, changes, _signed(label_id), n, label, WALK, -1, None, None, walk))
        labels = []
        for stop, fresh in candidates.items():
            for c in _folded(known[stop], fresh, width) if prune else fresh:
                walked, early, tight, _, changes, label_id, _, parent, trip, run, hop, end_hop, walk = c
                passed = (stop,) if hop is None else board[hop : end_hop + 1]
                path = (*parent.path, label_id)
                labels.append(Label(stop, -early, -tight, walked, changes, label_id, trip, run, None if hop is None else arr[end_hop], walk, parent.visited.union(passed), path, parent))
                if prune:
                    known[stop].append((walked, early, tight, 0, changes, label_id, 0, path))
        kept += labels
        candidates.clear()
        folded.clear()
    return kept


def _folded(known: list[tuple], fresh: list[tuple], width: int) -> list[tuple]:
    """Those of ``fresh`` that labels of fewer than ``width`` branches dominate; ``known`` labels stay and only dominate.

    A branch is the first label at which the path of a dominating label leaves that of the dominated one.
    """
    stay, chosen = [], []
    for b in sorted(known + fresh):
        if b[3]:
            early, tight = b[1], b[2]
            ahead = [a for a in stay if a[1] <= early and a[2] <= tight]
            if len(ahead) >= width:
                path = (*b[7].path, b[5])
                branches = {next((x for x, y in zip(a[7], path) if x != y), None) for a in ahead}
                if len(branches) >= width:
                    continue
            chosen.append(b)
            b = (*b[:7], (*b[7].path, b[5]))
        stay.append(b)
    return chosen


def journeys_of(
    net: Network,
    search_id: int,
    end: str,
    arrival_s: int,
    budget_s: int,
    width: int,
    asked: dict[str, int],
    transfer_s: int,
    span_s: int,
    max_legs: int | None,
    wide: bool,
    fold_rows: int,
    prune: bool,
) -> list[Label]:
    """Labels of one search at the origins it is ``asked`` for, at least as many as asked where there are; without ``prune`` all labels.

    Journeys are first looked for among those that leave within ``span_s`` before an origin's best one; for origins that lack some
    by then the span grows, in the end without bound.
    """
    at = net.stops.get(end)
    if at is None:
        return []
    if not prune:
        return kept_labels(net, search_id, at, arrival_s, budget_s, width, transfer_s, None, max_legs, wide, fold_rows)[1:]
    starts = {net.stops[s]: k for s, k in asked.items() if s in net.stops and s != end}
    best = latest_departures(net, at, arrival_s, budget_s, transfer_s, served(net, at, set(starts)), EVER)
    found = []
    while best:
        leave = {s: d - span_s if d >= span_s else EVER for s, (d, _) in best.items()}
        held = defaultdict(list)
        for label in kept_labels(net, search_id, at, arrival_s, budget_s, width, transfer_s, leave, max_legs, wide, fold_rows):
            if label.stop in leave and label.dep_s >= leave[label.stop]:
                held[label.stop].append(label)
        ended = {s for s in best if len(held[s]) >= starts[s] or leave[s] == EVER}
        found += [label for s in ended for label in held[s]]
        best = {s: b for s, b in best.items() if s not in ended}
        span_s = max(2 * span_s, 900)
    return found


def served(net: Network, end: int, origins: set[int]) -> set[int]:
    """Origins that something leaves, if anything comes to ``end``."""
    if net.into_at[end] == net.into_at[end + 1] and end not in net.walks_into:
        return set()
    return {o for o in origins if net.out_at[o] < net.out_at[o + 1] or o in net.walks_from}


def legs_of(net: Network, label: Label) -> list[dict]:
    """The legs of a label's journey, the last one first."""
    legs = []
    while label.parent is not None:
        on_foot = label.trip == WALK
        legs.append(
            {
                "kind": "walk" if on_foot else "ride",
                "trip_id": WALKING if on_foot else net.trips[label.trip].as_py(),
                "from_stop_id": net.names[label.stop],
                "to_stop_id": net.names[label.parent.stop],
                "dep_s": label.dep_s,
                "arr_s": label.arr_s,
                "walk_s": label.walk_s,
            }
        )
        label = label.parent
    return legs[::-1]


LEG = pa.struct(
    [("kind", pa.string()), ("trip_id", pa.string()), ("from_stop_id", pa.string()), ("to_stop_id", pa.string()),
     ("dep_s", pa.int32()), ("arr_s", pa.int32()), ("walk_s", pa.int64())]
)
LABELS = pa.schema(
    [("search_id", pa.int64()), ("stop_id", pa.string()), ("dep_s", pa.int32()), ("walked_s", pa.int64()),
     ("transfers", pa.int32()), ("label_id", pa.int64()), ("legs", pa.list_(LEG))]
)
DEPARTURES = pa.schema(
    [("search_id", pa.int64()), ("stop_id", pa.string()), ("dep_s", pa.int32()), ("walked_s", pa.int64())]
)


def _batches(searches: Iterable[pa.RecordBatch], tables: tuple[str, str], schema: pa.Schema, answers: Callable[[Network, dict], Iterable[dict]]) -> Iterator[pa.RecordBatch]:
    """What ``answers`` gives for each search, in batches; the network is read when there is a search."""
    net, rows = None, []
    for batch in searches:
        for search in batch.to_pylist():
            net = net or read_network(*tables)
            for row in answers(net, search):
                rows.append(row)
                if len(rows) >= ANSWERS:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows = []
    if rows:
        yield pa.RecordBatch.from_pylist(rows, schema)


def departures_run(tables: tuple[str, str], transfer_s: int) -> Callable:
    """For ``mapInArrow`` over searches: the latest departure from each origin."""

    def answers(net: Network, search: dict) -> Iterator[dict]:
        end = net.stops.get(search["to_stop_id"])
        origins = {net.stops[o["stop_id"]] for o in search["origins"] if o["stop_id"] in net.stops}
        if end is not None and (origins := served(net, end, origins)):
            for at, (dep_s, walked_s) in latest_departures(net, end, search["arrival_s"], search["budget_s"], transfer_s, origins, 0).items():
                yield {"search_id": search["search_id"], "stop_id": net.names[at], "dep_s": dep_s, "walked_s": walked_s}

    return lambda searches: _batches(searches, tables, DEPARTURES, answers)


def labels_run(tables: tuple[str, str], **options) -> Callable:
    """For ``mapInArrow`` over searches: the labels of ``journeys_of`` with their legs."""

    def answers(net: Network, search: dict) -> Iterator[dict]:
        asked = {o["stop_id"]: o["k"] for o in search["origins"]}
        given = (search[c] for c in ("search_id", "to_stop_id", "arrival_s", "budget_s", "width"))
        for label in journeys_of(net, *given, asked, **options):
            yield {
                "search_id": search["search_id"], "stop_id": net.names[label.stop], "dep_s": label.dep_s, "walked_s": label.walked_s,
                "transfers": label.transfers, "label_id": label.label_id, "legs": legs_of(net, label),
            }

    return lambda searches: _batches(searches, tables, LABELS, answers)
