"""recsmith.sinks"""
