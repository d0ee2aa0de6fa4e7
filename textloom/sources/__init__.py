"""textloom.sources"""
