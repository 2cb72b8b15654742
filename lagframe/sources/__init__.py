"""lagframe.sources"""
