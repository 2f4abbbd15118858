"""Packet-by-packet session fold in plain Python, to check the Spark plans against."""

STEPS = [
    # state before, flag, sent by originator (None: either), state after; the first match counts
    ("S0", "fin", True, "SH"),
    ("S0", "fin", None, "SF"),
    ("S1", "fin", None, "SF"),
    ("S0", "rst", False, "REJ"),
    ("S1", "rst", True, "RSTO"),
    ("S1", "rst", False, "RSTR"),
    ("S0", "rst", True, "RSTOS0"),
    ("OTH", "rst", False, "RSTRH"),
    ("OTH", "fin", None, "SHR"),
]


def step(state, p, by_orig):
    if p["syn"]:
        return "S1" if p["ack"] else "S0"
    for before, flag, sender, after in STEPS:
        if state == before and p[flag] and sender in (None, by_orig):
            return after
    return state


def orient(p, first):
    """The originating endpoint that a packet shows, or None."""
    src, dst = (p["id_orig_h"], p["id_orig_p"]), (p["id_resp_h"], p["id_resp_p"])
    if p["syn"]:
        return dst if p["ack"] else src
    if src[1] != dst[1]:
        return src if src[1] > dst[1] else dst
    if not first and p["ack_num"] == 0:
        return dst
    if not first and p["seq_num"] == 0:
        return src
    return None


def sessions(packets, idle_ns=4_000_000_000, max_span_ms=None):
    """(endpoints, session_ts) -> summary, folding packets by (ts_ns, frame_no)."""
    current, out = {}, {}
    for p in sorted(packets, key=lambda p: (p["ts_ns"], p["frame_no"])):
        src, dst = (p["id_orig_h"], p["id_orig_p"]), (p["id_resp_h"], p["id_resp_p"])
        flow = tuple(sorted([src, dst]))
        s = current.get(flow)
        if (
            s is None
            or p["ts_ns"] - s["last"] >= idle_ns
            or (max_span_ms is not None and (p["ts_ns"] - s["start"]) // 1_000_000 > max_span_ms)
        ):
            s = {"start": p["ts_ns"], "known": False, "orig": src, "state": None, "pkts": {}, "bytes": {}}
            current[flow] = out[flow, p["ts_ns"]] = s
        first = s["state"] is None
        if not s["known"]:
            shown = orient(p, first)
            if shown is not None:
                s["known"], s["orig"] = True, shown
        if first:
            s["state"] = ("S1" if p["ack"] else "S0") if p["syn"] else "OTH"
        else:
            s["state"] = step(s["state"], p, src == s["orig"])
        s["last"] = p["ts_ns"]
        s["pkts"][src] = s["pkts"].get(src, 0) + 1
        s["bytes"][src] = s["bytes"].get(src, 0) + p["bytes"]
    return out


def summary_rows(found):
    rows = []
    for (flow, start), s in found.items():
        orig = s["orig"]
        resp = flow[1] if orig == flow[0] else flow[0]
        rows.append(
            (
                *orig, *resp, start, s["last"], s["state"],
                s["pkts"].get(orig, 0), s["pkts"].get(resp, 0), s["bytes"].get(orig, 0), s["bytes"].get(resp, 0),
            )
        )
    return sorted(rows)
