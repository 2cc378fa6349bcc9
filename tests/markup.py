"""Hand-written game pages with a known reading."""

from courtstats import fixed

WIDTHS = [1, 1, 2, 2, 2, 3, 3, 2, 4]


def div(css_class, content):
    return f'<div class="{css_class}">{content}</div>'


def group(rows, first, width):
    heads = "".join(
        div(fixed.HEADING_CLASS, s) for s in fixed.PAGE_STATS[first : first + width]
    )
    lines = "".join(
        div(
            fixed.ROW_CLASS,
            "".join(div(fixed.CELL_CLASS, c) for c in row[first : first + width]),
        )
        for row in rows
    )
    return div(fixed.GROUP_CLASS, heads + div(fixed.ROW_CLASS, "") + lines)


def side(names, rows, team_row):
    """``rows`` are the players' rows, the team row if any, and the total row."""
    players = "".join(
        f'<div class="x"><div><a href="/euroleague/players/{n}/00{i}/" '
        f'class="{fixed.PLAYER_LINK_CLASS}"><b>{n}</b></a></div></div>'
        for i, n in enumerate(names)
    )
    closing = ("<div><b> Team</b></div>" if team_row else "") + "<div><b>Total</b></div>"
    container = div(fixed.NAMES_CLASS, f"<div>P</div><div><div></div></div>{players}{closing}")
    firsts = [sum(WIDTHS[:k]) for k in range(len(WIDTHS))]
    return container + "".join(group(rows, f, w) for f, w in zip(firsts, WIDTHS))


def page(home, away, info, body):
    items = "".join(f'<li class="{fixed.INFO_CLASS}">{i}</li>' for i in info)
    clubs = "".join(
        f'<h1 class="big {fixed.CLUB_CLASS}">\n {c} </h1>' for c in (home, away)
    )
    decoy = f"<script>var x = '<div class=\"{fixed.GROUP_CLASS}\">';</script>"
    return f"<html><body>{decoy}{clubs}<ul>{items}</ul>{body}</body></html>"


def stats(minutes="10:30", points="5", pairs=("1/2", "2/3", "0/0"), percents=("50%", "66.7%", "0%"), rest=None, plus_minus="3"):
    shots = [x for pair in zip(pairs, percents) for x in pair]
    rest = rest or [str(n) for n in range(1, 12)]
    return [minutes, points, *shots, *rest, plus_minus]


INFO = ["Regular Season Round 7", "7 Oct 2022", "Arena", "20:00"]
