"""textloom.streaming"""
