"""Plain Python answers to the conversation operators: whole tries, and every edit of every turn."""

import hashlib
import heapq
import re
import zlib
from collections import defaultdict


def key(turn):
    return (turn is not None, turn or 0)


def by_conversation(rows, null=""):
    held = defaultdict(list)
    for conv, turn, role, text in rows:
        held[conv].append((turn, null if role is None else role, null if text is None else text))
    return {c: sorted(t, key=lambda r: (key(r[0]), r[1], r[2])) for c, t in held.items()}


def rebuilt(rows):
    convs = {c: [r[1:] for r in t] for c, t in by_conversation(rows).items()}
    out = {}
    for c, own in convs.items():
        h = 0 if c is None else zlib.crc32(str(c).encode()) % 9
        out[c] = (convs.get(c - c % 5, [])[:h] if c is not None else []) + own[h:]
    return out


def trie(rows):
    """The rows of op11 by prefix, from every prefix of every conversation."""
    members = defaultdict(list)
    ends = defaultdict(list)
    for c, turns in rebuilt(rows).items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node in members:
        own = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] += own
            leaves[node[:d]] += not children[node]

    def least(node):
        return min((c for c in members[node] if c is not None), default=None)

    out = []
    for node in members:
        ids = ",".join(str(c) for c in sorted(c for c in ends[node] if c is not None))
        out.append(
            (
                least(node),
                len(node),
                least(node[:-1]) if node else None,
                len(members[node]),
                children[node],
                leaves[node],
                saved[node],
                hashlib.sha256(ids.encode()).hexdigest(),
            )
        )
    return out


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        names = [" " if x is None else x for x in (conv, turn)]
        fault = zlib.crc32(f"{names[0]}:{names[1]}".encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        if fault == 1:
            text = ""
        elif fault == 2:
            text = re.sub("[.!?]", "", text)
        elif fault == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    return out


def faults(turns):
    seen, kinds = set(), []
    for _, role, text in turns:
        bare = text.strip(" \t\n\x0b\x0c\r")
        if not bare:
            kinds.append("blank")
        elif (role, text) in seen:
            kinds.append("duplicate")
        else:
            kinds.append("truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return kinds


def repair(turns):
    """(cost, audit, repaired turns): a best-first search over costs and whole edit strings."""
    kinds = faults(turns)
    heap = [(0, "", 0, "", ())]
    done = set()
    while heap:
        cost, audit, i, state, made = heapq.heappop(heap)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(turns) and state in ("", "a"):
            return cost, audit, made
        follows = "a" if state == "u" else "u"
        role = {"u": "user", "a": "assistant"}[follows]
        # In the order of the heap a shorter edit string comes first, as in ASCII order.
        heapq.heappush(heap, (cost + 2, audit + "I", i, follows, (*made, (role, ""))))
        if i < len(turns):
            _, own, text = turns[i]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, state, made))
            if kinds[i] in ("", "truncated"):
                extra = kinds[i] == "truncated"
                heapq.heappush(
                    heap, (cost + 2 + extra, audit + "R", i + 1, follows, (*made, (role, text)))
                )
                if own[:1] == follows or own[:1] == "s" and state == "":
                    heapq.heappush(
                        heap, (cost + extra, audit + "K", i + 1, own[:1], (*made, (own, text)))
                    )
    raise AssertionError("a conversation can always be emptied")


def repairs(rows):
    """The rows of op13 for rows already damaged, by conversation."""
    out = {}
    for conv, turns in by_conversation(rows).items():
        numbers = [t for t, _, _ in turns if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        kinds = faults(turns)
        initials = [role[:1] for _, role, _ in turns]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit, made = repair(turns)
        lines = "\n".join(f"{role}:{text}" for role, text in made)
        out[conv] = (
            gaps,
            *(kinds.count(k) for k in ("blank", "duplicate", "truncated")),
            illegal,
            cost,
            audit,
            hashlib.sha256(lines.encode()).hexdigest(),
        )
    return out
