"""textloom.plans"""
