"""riskgraph.streaming"""
