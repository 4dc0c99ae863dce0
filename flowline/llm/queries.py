"""The queries of this package and their SQL."""

from __future__ import annotations

from flowline.llm import anchors, bitplane, cascade, doubling, graphann, htmlcrf, hyperminhash, mixing, nbest, periodic, secrets, toxicity, voronoi

QUERIES = {
    "op1_htmlcrf": htmlcrf.op1_htmlcrf,
    "op2_hyperminhash": hyperminhash.op2_hyperminhash,
    "op3_nbest": nbest.op3_nbest,
    "op4_doubling": doubling.op4_doubling,
    "op5_secrets": secrets.op5_secrets,
    "op6_voronoi": voronoi.op6_voronoi,
    "op7_bitplane": bitplane.op7_bitplane,
    "op8_mixing": mixing.op8_mixing,
    "op9_toxicity": toxicity.op9_toxicity,
    "op10_graphann": graphann.op10_graphann,
    "op11_anchors": anchors.op11_anchors,
    "op12_periodic": periodic.op12_periodic,
    "op13_cascade": cascade.op13_cascade,
}

ORACLE = {
    "op6_voronoi": voronoi.oracle_sql(),
    "op8_mixing": mixing.oracle_sql(),
    "op13_cascade": cascade.oracle_sql(),
}
