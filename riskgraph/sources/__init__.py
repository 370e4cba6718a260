"""riskgraph.sources"""
