"""codexlake.plans"""
