"""riskgraph.plans"""
