"""codexlake.functions"""
