"""riskgraph.functions"""
