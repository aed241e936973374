"""recsmith.streaming"""
