"""textloom.operators"""
