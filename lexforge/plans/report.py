"""The ranking as a page: tables of the outer deciles, filings of a ticker on demand, and a small server for it."""

from __future__ import annotations

import html
import json
from http.server import BaseHTTPRequestHandler, HTTPServer

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import rank

HEADINGS = {10: "Top tenth: most negative wording", 1: "Bottom tenth: least negative wording"}
TITLES = {"mdna": "Management discussion", "risk": "Risk factors"}


def shown_rows(ranks: DataFrame, shown: tuple[int, ...] = rank.DISPLAYED) -> DataFrame:
    """section and the rows of its shown deciles, for both sections."""
    parts = [rank.decile_rows(ranks, k).where(F.col("decile").isin(*shown)).select(F.lit(k).alias("section"), "*") for k in rank.SHORT.values()]
    return parts[0].unionByName(parts[1])


def context(scores: DataFrame, filings: DataFrame, members: DataFrame, shown: tuple[int, ...] = rank.DISPLAYED, n_filings: int = 4) -> dict:
    """Rows of the shown deciles, filings of the tickers in them, boundaries and counts: a page's worth, collected here."""
    ranks = rank.compute_ranks(scores, filings, members, n_filings).persist()
    rows = [r.asDict() for r in shown_rows(ranks, shown).orderBy("section", "decile", "rank").collect()]
    deciles = {n: {k: [{x: r[x] for x in r if x != "section"} for r in rows if r["decile"] == n and r["section"] == k] for k in rank.SHORT.values()} for n in shown}
    counts = rank.scored_counts(ranks).first()
    summary = {k: {"boundaries": [r["boundary"] for r in rank.decile_boundaries(ranks, f"mean_neg_{k}").orderBy("position").collect()], "n_scored": counts[f"n_scored_{k}"]} for k in rank.SHORT.values()}
    visible = ranks.where(F.col("decile_mdna").isin(*shown) | F.col("decile_risk").isin(*shown))
    detail: dict[str, list[dict]] = {}
    ordered = rank.filing_detail(scores, filings, members, visible).orderBy(*rank.detail_order())
    for r in rank.display_rows(ordered).collect():
        row = r.asDict()
        detail.setdefault(row.pop("ticker"), []).append(row)
    ranks.unpersist()
    return {"deciles": deciles, "summary": summary, "detail": detail}


def island(data: object) -> str:
    """JSON that can stand within a script element."""
    return json.dumps(data, ensure_ascii=False).replace("<", "\\u003c").replace(">", "\\u003e").replace("&", "\\u0026")


def company(row: dict) -> str:
    """One company: a line that opens to its filings."""
    e = html.escape
    return f'<details data-of="{e(row["ticker"])}"><summary><b>{row["rank"]}</b><i style="background:{e(row["sector_colour"])}" title="{e(row["sector"])}"></i><span>{e(row["ticker"])}</span><span>{e(row["name"])}</span><span>{100 * row["mean_neg"]:.3f}%</span><span>{row["filing_count"]} filings</span></summary></details>'


STYLE = """
body { margin: 2rem auto; max-width: 80rem; font: 15px/1.5 system-ui; color: #222 }
nav a { margin-right: 1.5rem }
section { display: none }
section:target, body:not(:has(section:target)) section:first-of-type { display: block }
.columns { display: grid; grid-template-columns: 1fr 1fr; gap: 2rem }
summary { display: grid; grid-template-columns: 2rem 1rem 5rem 1fr 5rem 6rem; gap: .5rem; cursor: pointer }
summary i { width: .8rem; height: .8rem; border-radius: 50%; align-self: center }
dl { display: grid; grid-template-columns: repeat(5, auto); font-size: 13px; margin: 0 0 1rem 3rem }
"""
#: A company's filings are made when its line is opened for the first time. Which tenth is shown is up to the address.
SCRIPT = """
const known = JSON.parse(document.querySelector('#detail').textContent);
addEventListener('toggle', event => {
  const at = event.target;
  if (!at.open || at.querySelector('dl')) return;
  const list = at.appendChild(document.createElement('dl'));
  for (const filing of known[at.dataset.of] ?? [])
    for (const value of [filing.acceptance_dt, filing.period_of_report, filing.section, filing.neg == null ? '' : (100 * filing.neg).toFixed(3) + '%', filing.total_words + ' words'])
      list.appendChild(document.createElement('dd')).textContent = value;
  if (!list.childElementCount) list.textContent = 'There are no filings of this company.';
}, true);
"""


def render(data: dict, refreshed: str) -> str:
    e, shown = html.escape, list(data["deciles"])
    heading = lambda n: HEADINGS.get(n, f"Tenth {n} of 10")
    links = "".join(f'<a href="#tenth{n}">{e(heading(n))}</a>' for n in shown)
    facts = "".join(f"<li>{e(TITLES[k])}: {s['n_scored']} companies" + (", limits of the tenths at " + ", ".join(f"{100 * b:.2f}%" for b in s["boundaries"]) if s["boundaries"] else "") + "</li>" for k, s in data["summary"].items())
    lists = lambda rows: "".join(map(company, rows)) or "<p>Nobody is in this tenth.</p>"
    body = "".join(f'<section id="tenth{n}"><h2>{e(heading(n))}</h2><div class="columns">' + "".join(f"<div><h3>{e(TITLES[k])}</h3>{lists(rows)}</div>" for k, rows in data["deciles"][n].items()) + "</div></section>" for n in shown)
    return f'<!DOCTYPE html><html lang="en"><meta charset="utf-8"><title>Negative wording in filings</title><style>{STYLE}</style><h1>Negative wording in filings</h1><p>As of {e(refreshed)}</p><ul>{facts}</ul><nav>{links}</nav>{body}<script type="application/json" id="detail">{island(data["detail"])}</script><script>{SCRIPT}</script></html>'


def server(page, host: str = "127.0.0.1", port: int = 8080, log_requests: bool = False) -> HTTPServer:
    """Serves page() at / and a sign of life at /ping. page gives a rendered page; no job runs for a request."""

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):
            route = self.path.partition("?")[0]
            status, kind, text = (200, "text/html", page()) if route == "/" else (200, "text/plain", "up") if route == "/ping" else (404, "text/plain", "no such page")
            data = text.encode()
            self.send_response(status)
            self.send_header("Content-Type", f"{kind}; charset=utf-8")
            self.send_header("Content-Length", str(len(data)))
            self.end_headers()
            self.wfile.write(data)

        def log_message(self, form, *args):
            if log_requests:
                super().log_message(form, *args)

    return HTTPServer((host, port), Handler)
