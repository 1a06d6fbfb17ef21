"""Plain one-by-one ledger, the standard that replays are held against."""

from __future__ import annotations

from decimal import Decimal


def replay(commands, openings):
    """``commands``: (cmd_id, ts, kind, src, dst, amount). Returns verdicts and closing balances."""
    balance = dict(openings)
    out = {}
    for cmd, _ts, _kind, src, dst, amount in sorted(commands, key=lambda c: (c[1], c[0])):
        if int(amount) <= 0:
            out[cmd] = (False, "Invalid amount")
        elif src is not None and src == dst:
            out[cmd] = (False, "Same source and destination accounts not allowed")
        elif any(a is not None and a not in balance for a in (src, dst)):
            out[cmd] = (False, "No account data found")
        elif src is not None and balance[src] < amount:
            out[cmd] = (False, "Insufficient balance")
        else:
            if src is not None:
                balance[src] -= amount
            if dst is not None:
                balance[dst] += amount
            out[cmd] = (True, None)
    return out, balance


def money(cents: int) -> Decimal:
    return Decimal(cents).scaleb(-2)
