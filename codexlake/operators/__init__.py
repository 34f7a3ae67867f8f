"""codexlake.operators"""
