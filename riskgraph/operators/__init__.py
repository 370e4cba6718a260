"""riskgraph.operators"""
