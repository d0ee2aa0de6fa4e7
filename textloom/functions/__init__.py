"""textloom.functions"""
