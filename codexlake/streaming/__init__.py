"""codexlake.streaming"""
