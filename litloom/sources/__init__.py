"""litloom.sources"""
