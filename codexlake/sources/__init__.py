"""codexlake.sources"""
