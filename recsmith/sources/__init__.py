"""recsmith.sources"""
