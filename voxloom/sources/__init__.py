"""voxloom.sources"""
